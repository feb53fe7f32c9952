import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from barlake.functions.prices import exact_mean
from barlake.operators.bars import ohlcv_bars, price_alerts, with_reference_average
from barlake.operators.load import daily_rows, enrich_facts
from barlake.schemas import WAREHOUSE_TABLES
from barlake.sources.warehouse import Warehouse

T0 = dt.datetime(2024, 1, 2, 10, 0)


def ticks(spark, rows):
    return spark.createDataFrame(
        [("A", p, v, T0 + dt.timedelta(seconds=s)) for p, v, s in rows],
        "ticker string, price double, volume bigint, event_time timestamp_ntz",
    )


@pytest.mark.parametrize(
    "values", [[1e-7, 2e-7, 3e-7], [4e-7, 4e-7], [1e13, 1.0, 1e-7], [1e300, 1e300], [1e19] * 20, [0.1] * 10, [None], []]
)
def test_mean_keeps_small_and_large_prices(spark, values):
    got = spark.createDataFrame([(v,) for v in values], "x double").agg(exact_mean(F.col("x"))).first()[0]
    known = [v for v in values if v is not None]
    if not known:
        assert got is None
    else:
        assert got == pytest.approx(math.fsum(known) / len(known), rel=1e-11)


def test_small_moves_raise_alerts(spark):
    bars = ohlcv_bars(ticks(spark, [(1e-7, 1, 0), (2e-7, 1, 61), (3e-7, 1, 122)]))
    got = price_alerts(with_reference_average(bars), 2.0).orderBy("window_start").collect()
    assert [round(r["move_pct"], 6) for r in got] == [100.0, 100.0]


def test_huge_prices_and_volumes_do_not_stop_the_bars(spark):
    rows = [(1e13, 2**62, 0), (1e13, 2**62, 1), (5.0, 3, 61), (6.0, 4, 62)]
    got = with_reference_average(ohlcv_bars(ticks(spark, rows))).orderBy("window_start").collect()
    assert [(r["volume"], r["tick_count"], r["high"]) for r in got] == [(None, 2, 1e13), (7, 2, 6.0)]
    assert got[1]["reference_avg"] == 1e13


DAY = "ticker string, price_date timestamp_ntz, close_price double"


def test_latest_time_of_the_day_is_loaded(spark):
    at = lambda h: dt.datetime(2024, 1, 2, h)
    with_seq = spark.createDataFrame(
        [("A", at(16), 2.0, 1), ("A", at(9), 1.0, 2), ("B", at(9), 5.0, 1), ("B", at(9), 6.0, 2)], DAY + ", seq long"
    )
    without = with_seq.drop("seq")
    dim = spark.createDataFrame([("A", 7)], "ticker string, company_id long")
    for rows in (with_seq, without):
        got = {r["ticker"]: r for r in enrich_facts(rows, dim, "b").collect()}
        assert got["A"]["close_price"] == 2.0 and got["B"]["close_price"] == 6.0 and len(got) == 2
        assert got["A"]["price_date"] == dt.datetime(2024, 1, 2) and got["A"]["company_id"] == 7
    assert daily_rows(without).columns == without.columns


def _dim_row(spark):
    schema = WAREHOUSE_TABLES["dim_company"]
    row = tuple(
        1 if f.dataType.typeName() == "long" else dt.datetime(2024, 1, 1) if "timestamp" in f.dataType.typeName() else "A"
        for f in schema.fields
    )
    return spark.createDataFrame([row], schema)


def test_broken_replace_leaves_the_committed_version(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path))
    wh.ensure_tables(["dim_company"])
    wh.replace("dim_company", _dim_row(spark))

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        for step in ("_write_version", "_set_version"):
            m.setattr(Warehouse, step, broken)
            with pytest.raises(OSError):
                wh.replace("dim_company", _dim_row(spark).limit(0))
    again = Warehouse(spark, str(tmp_path))
    again.ensure_tables(["dim_company"])
    assert again.read("dim_company").count() == 1


def test_table_with_rows_but_no_commit_is_not_created_over(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh._write_version("dim_company", _dim_row(spark), "20240101000000-a")
    with pytest.raises(RuntimeError, match="no committed version"):
        wh.ensure_tables(["dim_company"])
    wh._set_version("dim_company", "20240101000000-a")
    assert wh.read("dim_company").count() == 1


def test_unreadable_partition_is_an_error(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.ensure_tables(["fact_intraday_bars"])
    assert wh.read_partitions("fact_intraday_bars", "bar_date", ["2024-01-01"]).count() == 0
    bad = tmp_path / "fact_intraday_bars" / "v=0" / "bar_date=2024-01-01"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"not a parquet file")
    with pytest.raises(Exception):
        wh.read_partitions("fact_intraday_bars", "bar_date", ["2024-01-01"]).collect()
