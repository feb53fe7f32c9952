"""Random small frames: Spark operators against a direct pandas statement of the rules."""

import datetime as dt
import math

import pandas as pd
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from barlake.operators.quality import date_gaps, quality_results
from barlake.operators.transform import dedupe_last, with_daily_return

from .conftest import QUALITY_COLUMNS

TICKERS = st.sampled_from(["AAPL", "MSFT", "aapl", "TOOLONG", "", None])
PRICES = st.one_of(st.none(), st.floats(min_value=-5, max_value=50, allow_nan=False).map(lambda x: round(x, 2)))
DAYS = st.one_of(st.none(), st.integers(min_value=0, max_value=40).map(lambda k: dt.datetime(2026, 1, 1) + dt.timedelta(days=k)))
ROW = st.tuples(TICKERS, DAYS, PRICES, PRICES, PRICES, PRICES, PRICES, st.integers(min_value=-2, max_value=1000))
SETTINGS = settings(
    max_examples=25, deadline=None, suppress_health_check=list(HealthCheck), phases=[Phase.explicit, Phase.generate]
)


def pandas_checks(pdf: pd.DataFrame) -> dict:
    """The nine checks, stated directly on a pandas frame."""
    t = pdf["ticker"]
    out = {}
    out["null_tickers"] = int(t.isna().sum() + t.dropna().map(lambda s: s.strip() == "").sum())
    out["null_dates"] = int(pdf["price_date"].isna().sum())
    cols = ["open_price", "high_price", "low_price", "close_price", "adj_close_price"]
    out["negative_prices"] = int(sum((pdf[c] < 0).sum() for c in cols))
    out["negative_volume"] = int((pdf["volume"] < 0).sum())
    key = pdf[["ticker", "price_date"]].astype(str)
    out["duplicate_rows"] = int(key.duplicated(keep=False).sum())

    def gt(a, b):
        return (pdf[a] > pdf[b]).fillna(False)

    bad = gt("low_price", "open_price") | gt("low_price", "close_price") | gt("open_price", "high_price") | gt("close_price", "high_price")
    out["price_relationships"] = int(bad.sum())
    import re

    out["invalid_ticker_format"] = int(t.dropna().map(lambda s: not re.fullmatch(r"[A-Z]{1,5}", s)).sum())
    gaps = 0
    for _, g in pdf.dropna(subset=["ticker", "price_date"]).groupby("ticker"):
        days = sorted(set(g["price_date"]))
        gaps += sum(1 for a, b in zip(days, days[1:]) if (b - a).days > 5)
    out["date_gaps"] = gaps
    out["column_types"] = 0
    return out


@SETTINGS
@given(st.lists(ROW, min_size=1, max_size=25))
def test_quality_checks_match_pandas(spark, rows):
    df = spark.createDataFrame(rows, QUALITY_COLUMNS)
    got = {r["check"]: r["failures"] for r in quality_results(df).collect()}
    pdf = pd.DataFrame(rows, columns=[c.split()[0] for c in QUALITY_COLUMNS.split(", ")])
    prices = ["open_price", "high_price", "low_price", "close_price", "adj_close_price"]
    pdf[prices] = pdf[prices].astype(float)
    assert got == pandas_checks(pdf)
    assert date_gaps(df).count() == got["date_gaps"]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 12), PRICES), min_size=1, max_size=30))
def test_keep_last_and_return_match_pandas(spark, raw):
    rows = [(t, dt.datetime(2026, 1, 1) + dt.timedelta(days=k), p, i) for i, (t, k, p) in enumerate(raw)]
    df = spark.createDataFrame(rows, "ticker string, price_date timestamp_ntz, close_price double, seq bigint")
    got = with_daily_return(dedupe_last(df, "seq")).toPandas().sort_values(["ticker", "price_date"])
    pdf = pd.DataFrame(rows, columns=["ticker", "price_date", "close_price", "seq"])
    want = pdf.drop_duplicates(["ticker", "price_date"], keep="last").sort_values(["ticker", "price_date"])
    prev = want.groupby("ticker")["close_price"].shift(1)
    want = want.assign(daily_return=want["close_price"] / prev - 1)
    assert list(got["seq"]) == list(want["seq"])
    for a, b in zip(got["daily_return"], want["daily_return"]):
        if b is None or (isinstance(b, float) and (math.isnan(b) or math.isinf(b))):
            assert a is None or math.isnan(a)
        else:
            assert abs(a - b) < 1e-12
