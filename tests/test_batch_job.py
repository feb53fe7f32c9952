import datetime as dt
import json
import os

from pyspark.sql import functions as F

from barlake.plans.batch_job import BatchConfig, run_batch
from barlake.sources import testdata as src
from barlake.sources.warehouse import Warehouse

from .conftest import SF_SMALL

TICKERS = ["house", "MACHI", " build ", "AUTOM", "FURNI", "ZZZZ"]


def cfg(tmp_path, batch_id):
    return BatchConfig(
        tickers=TICKERS,
        warehouse=str(tmp_path / "wh"),
        reports_dir=str(tmp_path / "reports"),
        bronze_root=str(tmp_path / "bronze"),
        today=dt.date(2001, 9, 1),
        lookback_days=3000,
        batch_id=batch_id,
    )


def test_run_then_rerun(spark, tmp_path):
    feed = src.price_feed(spark, SF_SMALL)
    attrs = src.company_source(spark, SF_SMALL)
    r1 = run_batch(spark, feed, cfg(tmp_path, "b1"), attrs)
    assert r1["status"] == "SUCCESS", r1["error"]
    assert r1["failed_tickers"] == ["ZZZZ"]
    assert r1["rows_inserted"] == r1["rows_extracted"] > 0 and r1["rows_skipped"] == 0
    # quality report exists and names the batch
    report = json.loads(open(os.path.join(tmp_path, "reports", "quality_report_b1.json")).read())
    assert report["rows_inserted"] == r1["rows_inserted"]
    assert set(report["checks"]) >= {"null_tickers", "date_gaps", "price_relationships"}

    wh = Warehouse(spark, str(tmp_path / "wh"))
    # the report names the gaps that the table holds
    stored_gaps = wh.read("date_gaps").where("batch_id = 'b1'").orderBy("ticker", "gap_after").limit(1000).collect()
    assert len(stored_gaps) > 0 and report["checks"]["date_gaps"]["details"] == [
        {"ticker": g.ticker, "gap_after": str(g.gap_after), "gap_calendar_days": g.gap_calendar_days}
        for g in stored_gaps
    ]
    facts = wh.read("fact_stock_prices")
    assert facts.count() == r1["rows_inserted"]
    assert facts.where(F.col("company_id").isNull()).count() == 0
    assert facts.groupBy("ticker", "price_date").count().where("count > 1").count() == 0
    dim = {r.ticker: r for r in wh.read("dim_company").collect()}
    assert set(dim) == {"HOUSE", "MACHI", "BUILD", "AUTOM", "FURNI"}
    assert dim["HOUSE"].company_name is None and dim["BUILD"].company_name == "Building Holdings"
    assert wh.read("dim_date").count() == 13149
    assert os.path.isdir(os.path.join(tmp_path, "bronze", "ticker=HOUSE"))

    # second run: windows start 2 days before the last stored date, nothing new
    r2 = run_batch(spark, feed, cfg(tmp_path, "b2"), attrs)
    assert r2["status"] == "SUCCESS", r2["error"]
    assert r2["rows_inserted"] == 0 and r2["rows_skipped"] == r2["rows_extracted"]
    runs = {r.batch_id: r for r in wh.read("pipeline_runs").collect()}
    assert runs["b1"].status == runs["b2"].status == "SUCCESS"
    assert runs["b2"].rows_inserted == 0


def test_critical_failure_is_audited_with_a_report(spark, tmp_path):
    feed = src.price_feed(spark, SF_SMALL).withColumn("Close", -F.col("Close"))
    r = run_batch(spark, feed, cfg(tmp_path, "bad"))
    assert r["status"] == "FAILED" and "negative_prices" in r["error"]
    assert os.path.exists(os.path.join(tmp_path, "reports", "quality_report_bad.json"))
    run = Warehouse(spark, str(tmp_path / "wh")).read("pipeline_runs").collect()[0]
    assert run.status == "FAILED" and run.quality_checks_passed is False
    assert "negative_prices" in run.error_message


def test_no_ticker_left_fails(spark, tmp_path):
    c = cfg(tmp_path, "none")
    c.tickers = [" ", ""]
    r = run_batch(spark, src.price_feed(spark, SF_SMALL), c)
    assert r["status"] == "FAILED" and "request is empty" in r["error"]


def test_fact_is_year_partitioned_and_pruned(spark, tmp_path):
    from barlake.operators.load import enrich_facts, new_rows
    from barlake.operators.dims import empty_dim_company

    feed = src.price_feed(spark, SF_SMALL)
    r = run_batch(spark, feed, cfg(tmp_path, "p1"))
    assert r["status"] == "SUCCESS", r["error"]
    wh = Warehouse(spark, str(tmp_path / "wh"))
    root = wh.path("fact_stock_prices")
    years = sorted(d for d in os.listdir(root) if d.startswith("price_year="))
    assert years and years[0] >= "price_year=1995"
    batch = spark.createDataFrame([("HOUSE", dt.datetime(2001, 7, 1), 1.0, 1)],
                                  "ticker string, price_date timestamp_ntz, close_price double, seq bigint")
    enriched = enrich_facts(batch, empty_dim_company(spark), "x")
    plan = new_rows(enriched, wh.read("fact_stock_prices"), dt.datetime(2001, 7, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(price_year" in plan and "(price_year#" in plan


def test_cli_runs_and_prints_json(spark, tmp_path, capsys):
    from barlake.plans.batch_job import main

    src_path = str(tmp_path / "raw")
    src.price_feed(spark, SF_SMALL).write.parquet(src_path)
    code = main(["--source", src_path, "--tickers", "HOUSE,MACHI", "--warehouse", str(tmp_path / "wh"),
                 "--reports", str(tmp_path / "rep"), "--today", "2001-09-01", "--lookback-days", "3000"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 0 and out["status"] == "SUCCESS" and out["rows_inserted"] > 0, out


def test_monitor_cli(spark, tmp_path, capsys):
    from barlake.streaming.monitor import main

    Warehouse(spark, str(tmp_path / "wh")).ensure_tables(["fact_intraday_bars", "alerts"])
    progress = tmp_path / "p.json"
    progress.write_text(json.dumps({"sources": [{"metrics": {"maxOffsetsBehindLatest": "5000"}}]}))
    code = main(["--warehouse", str(tmp_path / "wh"), "--progress", str(progress)])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 1 and out["lag"] == 5000 and out["total_bars"] == 0


def test_update_mode_applies_late_corrections(spark, tmp_path):
    feed = src.price_feed(spark, SF_SMALL)
    r1 = run_batch(spark, feed, cfg(tmp_path, "u1"))
    assert r1["status"] == "SUCCESS", r1["error"]
    wh = Warehouse(spark, str(tmp_path / "wh"))
    before = {(r.ticker, r.price_date): r.close_price for r in wh.read("fact_stock_prices").collect()}

    corrected = feed.withColumn("Close", F.col("Close") * 2)  # a corrected re-delivery
    c = cfg(tmp_path, "u2")
    c.on_conflict = "update"
    r2 = run_batch(spark, corrected, c)
    assert r2["status"] == "SUCCESS", r2["error"]
    assert r2["rows_inserted"] == 0 and r2["rows_updated"] == r2["rows_extracted"] > 0
    after = {(r.ticker, r.price_date): r.close_price for r in wh.read("fact_stock_prices").collect()}
    assert set(after) == set(before)  # nothing added, nothing lost
    changed = [k for k in after if after[k] != before[k]]
    assert len(changed) == r2["rows_updated"]
    assert all(abs(after[k] - 2 * before[k]) < 1e-9 for k in changed)
