import pytest
from pyspark.sql import functions as F

from barlake.operators.transform import (
    coerce_types,
    find_date_column,
    standardize_columns,
    transform_prices,
    wide_to_long,
)
from barlake.schemas import OUTPUT_COLUMNS

from .conftest import RAW_COLUMNS, d


def raw(spark, rows, schema=RAW_COLUMNS):
    return spark.createDataFrame(rows, schema)


def test_daily_return_per_ticker(spark):
    rows = [
        (d(2026, 1, 1), "AAPL", 1.0, 1.0, 1.0, 100.0, 100.0, 10),
        (d(2026, 1, 2), "AAPL", 1.0, 1.0, 1.0, 110.0, 110.0, 10),
        (d(2026, 1, 1), "MSFT", 1.0, 1.0, 1.0, 200.0, 200.0, 10),
        (d(2026, 1, 2), "MSFT", 1.0, 1.0, 1.0, 190.0, 190.0, 10),
    ]
    out = transform_prices(raw(spark, rows)).orderBy("ticker", "price_date").collect()
    got = [(r.ticker, r.daily_return) for r in out]
    assert got[0] == ("AAPL", None) and got[2] == ("MSFT", None)
    assert got[1][1] == pytest.approx(0.10)
    assert got[3][1] == pytest.approx(-0.05)


def test_keep_last_duplicate(spark):
    rows = [
        (d(2026, 1, 1), "AAPL", 1.0, 1.0, 1.0, 101.0, 101.0, 10, 1),
        (d(2026, 1, 1), "AAPL", 1.0, 1.0, 1.0, 102.0, 102.0, 10, 2),
    ]
    df = spark.createDataFrame(rows, RAW_COLUMNS + ", seq bigint")
    out = transform_prices(df).collect()
    assert len(out) == 1 and out[0].close_price == 102.0


def test_output_columns_and_empty_input(spark):
    out = transform_prices(raw(spark, []))
    assert out.columns == OUTPUT_COLUMNS
    assert out.count() == 0


def test_return_across_year_edge_and_gaps(spark):
    # the previous close lives in the previous year bucket, several buckets back
    rows = [
        (d(2020, 12, 31), "AAPL", 1.0, 1.0, 1.0, 100.0, 100.0, 1),
        (d(2023, 1, 2), "AAPL", 1.0, 1.0, 1.0, 120.0, 120.0, 1),
        (d(2023, 1, 3), "AAPL", 1.0, 1.0, 1.0, None, None, 1),
        (d(2023, 1, 4), "AAPL", 1.0, 1.0, 1.0, 130.0, 130.0, 1),
    ]
    out = transform_prices(raw(spark, rows)).orderBy("price_date").collect()
    rets = [r.daily_return for r in out]
    assert rets[0] is None
    assert rets[1] == pytest.approx(0.2)
    assert rets[2] is None and rets[3] is None  # no fill across a missing close


def test_date_column_detection():
    assert find_date_column(["x", "DateTime", "Date"]) == "DateTime"
    with pytest.raises(ValueError, match="date column"):
        find_date_column(["a", "b"])


def test_missing_columns_sorted_in_error(spark):
    df = spark.createDataFrame([(d(2026, 1, 1), "A", 1.0)], "Date timestamp_ntz, Ticker string, Close double")
    with pytest.raises(ValueError, match="adj_close_price, high_price, low_price, open_price, volume"):
        standardize_columns(df)


def test_flat_data_needs_ticker(spark):
    df = spark.createDataFrame([(d(2026, 1, 1), 1.0)], "Date timestamp_ntz, Close double")
    with pytest.raises(ValueError, match="Ticker"):
        standardize_columns(df)


def test_trimmed_names_and_coercion(spark):
    df = spark.createDataFrame(
        [(" 2026-01-05 ", "aapl", "1", "2", "0.5", "n/a", "1.5", "10")],
        "` Date` string, `Ticker ` string, Open string, High string, Low string, Close string, "
        "`Adj Close` string, Volume string",
    )
    out = coerce_types(standardize_columns(df)).collect()[0]
    assert out.ticker == "AAPL"
    assert out.price_date == d(2026, 1, 5)
    assert out.close_price is None and out.open_price == 1.0
    assert out.volume == 10.0


def test_bad_date_and_nan_become_null(spark):
    df = spark.createDataFrame(
        [("yesterday", "A", float("nan"), 1.0, 1.0, 1.0, 1.0, 1)],
        "Date string, Ticker string, Open double, High double, Low double, Close double, "
        "`Adj Close` double, Volume bigint",
    )
    out = coerce_types(standardize_columns(df)).collect()[0]
    assert out.price_date is None
    assert out.open_price is None


def test_zone_offset_moves_to_utc(spark):
    df = spark.createDataFrame(
        [("2026-01-05T10:00:00+02:00", "A", 1.0, 1.0, 1.0, 1.0, 1.0, 1)],
        "Date string, Ticker string, Open double, High double, Low double, Close double, "
        "`Adj Close` double, Volume bigint",
    )
    out = coerce_types(standardize_columns(df)).collect()[0]
    assert out.price_date == d(2026, 1, 5).replace(hour=8)


@pytest.mark.parametrize("field_first", [True, False])
def test_wide_to_long_both_orders(spark, field_first):
    fields = ["Open", "High", "Low", "Close", "Adj Close", "Volume"]
    cols = ["Date"]
    for t in ["AAPL", "MSFT"]:
        for f in fields:
            cols.append(f"{f}_{t}" if field_first else f"{t}_{f}")
    row = [d(2026, 1, 2)] + [float(i) for i in range(12)]
    df = spark.createDataFrame([row], ", ".join(f"`{c}` {'timestamp_ntz' if c == 'Date' else 'double'}" for c in cols))
    long = wide_to_long(df, "Date").orderBy("Ticker").collect()
    assert [r.Ticker for r in long] == ["AAPL", "MSFT"]
    assert long[0].Close == 3.0 and long[1].Close == 9.0
    assert long[1]["Adj Close"] == 10.0


def test_transform_of_unpivoted_frame(spark):
    cols = ["Date"] + [f"{f}_X" for f in ["Open", "High", "Low", "Close", "Adj Close", "Volume"]]
    rows = [[d(2026, 1, 1), 1.0, 2.0, 0.5, 10.0, 10.0, 5.0], [d(2026, 1, 2), 1.0, 2.0, 0.5, 11.0, 11.0, 5.0]]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` {'timestamp_ntz' if c == 'Date' else 'double'}" for c in cols))
    out = transform_prices(wide_to_long(df, "Date")).orderBy("price_date").collect()
    assert out[1].daily_return == pytest.approx(0.1)
    assert out[0].ticker == "X"


def test_loaded_at_is_the_given_run_time(spark):
    rows = [(d(2026, 1, 1), "AAPL", 1.0, 1.0, 1.0, 100.0, 100.0, 10)]
    stamp = F.lit("2026-02-01 12:00:00").cast("timestamp_ntz")
    out = transform_prices(raw(spark, rows), loaded_at=stamp).collect()[0]
    assert out.loaded_at == d(2026, 2, 1).replace(hour=12)
