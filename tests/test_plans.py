"""Plan shape: what the optimizer must keep doing at scale."""

import re

import pytest

import __spark_entry__ as entry_mod
from barlake.plans import catalog

from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_joins(spark, name):
    p = plan(entry_mod.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_bars_prune_columns_and_aggregate_map_side(spark):
    p = plan(entry_mod.queries()["price_alerts"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in p
    assert "partial_max_by" in p
    # the trailing window runs per (ticker, day bucket), never per ticker alone
    assert "hashpartitioning(ticker" in p and "_bkt" in p
    assert p.count("FileScan parquet") == 1


def test_transform_scans_once(spark):
    p = plan(entry_mod.queries()["clean_prices"](spark, SF_SMALL))
    assert p.count("FileScan parquet") == 2  # orders + customer, once each
    assert "partial_max_by" in p
    # keep-last is a hash aggregate (per-column max_by), not a sort-based one
    assert "SortAggregate" not in p


def test_daily_windows_run_per_ticker_after_dedupe(spark):
    p = plan(entry_mod.queries()["daily_return"](spark, SF_SMALL))
    window = [line for line in p.splitlines() if "Window [lag(" in line]
    assert window and "windowspecdefinition(ticker" in window[0]


def test_validation_filter_stays_above_the_parse(spark):
    p = plan(entry_mod.queries()["dead_letters"](spark, SF_SMALL))
    filt = [line for line in p.splitlines() if "Filter" in line]
    assert filt and all("parseJson" not in line for line in filt)


def test_extract_bounds_reach_the_scan(spark):
    from pyspark.sql import functions as F

    from barlake.operators.extract import incremental_extract
    from barlake.sources import testdata as src

    windows = spark.createDataFrame(
        [("HOUSE", "1998-01-01", "1998-02-01")], "ticker string, start_date string, end_date string"
    ).select("ticker", F.col("start_date").cast("date"), F.col("end_date").cast("date"))
    out = incremental_extract(src.price_feed(spark, SF_SMALL), windows, bounds=("1998-01-01", "1998-02-01"))
    p = plan(out)
    assert "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p


def test_latest_close_reads_the_feed_once(spark):
    p = plan(entry_mod.queries()["latest_close"](spark, SF_SMALL))
    assert p.count("FileScan parquet") == 2 and "Window" not in p


def test_ordinals_need_no_checkpoint(spark):
    for name in ("dim_company_upsert", "migrate_backfill", "fact_enriched", "replay_schedule", "price_trend", "star_slice"):
        p = plan(entry_mod.queries()[name](spark, SF_SMALL))
        assert "_pid" not in p and "_bucket" in p, name  # the checkpointed ordinal had _pid


@pytest.mark.parametrize("name", ["dead_letters", "valid_ticks", "tick_reject_reasons"])
def test_tick_check_stays_compiled(spark, name):
    # the JVM interprets methods of more than 8,000 bytes
    found = entry_mod.queries()[name](spark, SF_SMALL)
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    code = getattr(debug, "MODULE$").codegenString(found._jdf.queryExecution().executedPlan())
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000
