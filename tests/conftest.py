import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barlake.session import build_session, checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="barlake-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)  # tests only: a private folder when none is configured
    yield s
    s.stop()


def d(y, m, day):
    return dt.datetime(y, m, day)


RAW_COLUMNS = "Date timestamp_ntz, Ticker string, Open double, High double, Low double, " \
    "Close double, `Adj Close` double, Volume bigint"

QUALITY_COLUMNS = (
    "ticker string, price_date timestamp_ntz, open_price double, high_price double, "
    "low_price double, close_price double, adj_close_price double, volume bigint"
)


@pytest.fixture
def two_valid_rows():
    """Two clean rows (AAPL, MSFT) in the transformed layout."""
    return [
        ("AAPL", d(2026, 1, 2), 100.0, 105.0, 99.0, 104.0, 104.0, 1000),
        ("MSFT", d(2026, 1, 2), 200.0, 205.0, 199.0, 204.0, 204.0, 2000),
    ]
