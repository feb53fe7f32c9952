"""The daily batch job: extract -> Bronze -> transform -> quality -> dims -> load -> audit.

One lazy plan per step; the actions are the Bronze write, the quality
aggregate, the dimension write and the fact append. The transformed batch is
persisted between quality and load, which both read it. The job never
raises: it returns a result dict and records SUCCESS or FAILED in the audit
table (an audit failure on the failure path is logged and swallowed).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging
import sys
import time
import uuid
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barlake.functions.timecols import ntz_literal
from barlake.operators.dims import date_dimension, upsert_dim_company
from barlake.operators.extract import (
    company_info,
    failed_tickers,
    incremental_extract,
    normalise_requests,
    require_rows,
    require_tickers,
    start_dates,
    window_bounds,
)
from barlake.operators.load import (
    enrich_facts,
    last_stored_dates,
    load_counts,
    merge_rows,
    new_rows,
    to_fact_schema,
)
from barlake.operators.quality import CriticalQualityError, date_gaps, quality_results, summarize
from barlake.operators.transform import transform_prices
from barlake.schemas import LOOKBACK_DAYS, STATUS_FAILED, STATUS_SUCCESS
from barlake.sources.bronze import write_bronze_safely
from barlake.session import checkpoint_dir, join_path
from barlake.sources.warehouse import (
    DaysLog,
    QualityReport,
    Warehouse,
    fact_days,
    replace_partitions_via,
    write_audit_row,
    write_quality_report,
)

log = logging.getLogger(__name__)


def utc_now() -> dt.datetime:
    """Naive UTC, as stored."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass
class BatchConfig:
    tickers: list[str]
    warehouse: str
    reports_dir: str
    bronze_root: str | None = None
    lookback_days: int = LOOKBACK_DAYS
    today: dt.date | None = None
    batch_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    # "skip": stored (ticker, day) keys are left alone (the reference's behaviour);
    # "update": the batch's values replace them (late corrections are applied)
    on_conflict: str = "skip"


MAX_LISTED_FAILURES = 1_000
MAX_LISTED_GAPS = 1_000  # in the report; the table date_gaps has all


def seed_dim_date(wh: Warehouse) -> None:
    """Fill dim_date once (only when empty)."""
    if wh.is_empty("dim_date"):
        wh.append("dim_date", date_dimension(wh.spark))


def run_batch(
    spark: SparkSession,
    source: DataFrame,
    cfg: BatchConfig,
    attributes: DataFrame | None = None,
) -> dict:
    """Run the whole batch job over a raw price ``source`` (Date, Ticker, fields[, seq])."""
    if cfg.on_conflict not in ("skip", "update"):
        raise ValueError(f"on_conflict must be 'skip' or 'update', not {cfg.on_conflict!r}")
    started = utc_now()
    t0 = time.monotonic()
    batch_id = cfg.batch_id
    wh = Warehouse(spark, cfg.warehouse)
    summary: dict = {}
    counts = {"rows_extracted": 0, "rows_inserted": 0, "rows_skipped": 0}
    failed: list[str] = []
    persisted: list[DataFrame] = []
    try:
        wh.ensure_tables()
        seed_dim_date(wh)
        if "seq" not in source.columns:  # the order of the rows in the source, before any shuffle
            source = source.withColumn("seq", F.monotonically_increasing_id())

        requests = spark.createDataFrame([(",".join(cfg.tickers),)], "request string")
        tickers = normalise_requests(requests)
        require_tickers(tickers)

        facts = wh.read("fact_stock_prices")
        today = F.lit((cfg.today or started.date()).isoformat()).cast("date")
        windows = start_dates(tickers, last_stored_dates(facts, tickers), today, cfg.lookback_days)
        windows = windows.persist(StorageLevel.MEMORY_AND_DISK)  # one row per requested ticker
        persisted.append(windows)
        raw = incremental_extract(source, windows, bounds=window_bounds(windows))
        raw = raw.persist(StorageLevel.MEMORY_AND_DISK)
        persisted.append(raw)
        missing = failed_tickers(tickers, raw).persist(StorageLevel.MEMORY_AND_DISK)
        persisted.append(missing)
        wh.append("failed_tickers", missing.withColumn("batch_id", F.lit(batch_id)))
        # the run's summary names the first ones; the table has all
        failed = [r["ticker"] for r in missing.orderBy("ticker").limit(MAX_LISTED_FAILURES).collect()]
        require_rows(raw)

        if cfg.bronze_root:
            write_bronze_safely(raw, cfg.bronze_root, batch_id)

        clean = transform_prices(raw, loaded_at=ntz_literal(started))
        clean = clean.persist(StorageLevel.MEMORY_AND_DISK)
        persisted.append(clean)

        results = quality_results(clean).withColumn("batch_id", F.lit(batch_id))
        rows = results.collect()  # nine rows
        summary = summarize(rows)
        if not summary["checks"]["date_gaps"]["passed"]:
            summary["checks"]["date_gaps"]["details"] = _first_gaps(clean)
        counts["rows_extracted"] = clean.count()
        if summary["critical"]:
            # report first, so a failed run still leaves one (the reference does not)
            _report(spark, cfg, summary, counts, t0)
            raise CriticalQualityError(summary["critical"])
        wh.append("quality_results", spark.createDataFrame(rows, results.schema))
        wh.append("date_gaps", date_gaps(clean).withColumn("batch_id", F.lit(batch_id)))

        ok_tickers = tickers.join(missing, "ticker", "left_anti")
        info_src = attributes if attributes is not None else ok_tickers.select(
            "ticker",
            F.lit(None).cast("string").alias("company_name"),
            F.lit(None).cast("string").alias("sector"),
            F.lit(None).cast("string").alias("industry"),
        )
        dim = upsert_dim_company(
            wh.read("dim_company"), ok_tickers, company_info(ok_tickers, info_src),
            ntz_literal(started),
        )
        wh.replace("dim_company", dim)

        enriched = enrich_facts(clean, wh.read("dim_company"), batch_id)
        batch_obs = Observation("batch")
        new_obs = Observation("inserted")
        observed = enriched.observe(batch_obs, F.count(F.lit(1)).alias("n"))
        days = fact_days(wh)  # stored keys as bitmaps; the history is not read
        if cfg.on_conflict == "update":
            c = load_counts(enriched, facts, days=days).first()
            staging = join_path(checkpoint_dir(spark), f"merge-{batch_id}")
            with DaysLog(wh, batch_id, enriched):
                replace_partitions_via(wh, "fact_stock_prices", merge_rows(enriched, facts), staging)
            counts["rows_inserted"], counts["rows_updated"] = c["rows_inserted"], c["rows_skipped"]
            counts["rows_skipped"] = 0
        else:
            fresh = new_rows(observed, facts, days=days).observe(new_obs, F.count(F.lit(1)).alias("n"))
            with DaysLog(wh, batch_id, enriched):
                wh.append("fact_stock_prices", to_fact_schema(fresh))
            in_batch = batch_obs.get["n"]
            counts["rows_inserted"] = new_obs.get["n"]
            counts["rows_skipped"] = in_batch - counts["rows_inserted"]

        elapsed = time.monotonic() - t0
        report_path = _report(spark, cfg, summary, counts, t0)
        write_audit_row(wh, _audit(cfg, started, STATUS_SUCCESS, counts, summary.get("overall_passed", False), None))
        return {
            "status": STATUS_SUCCESS,
            "batch_id": batch_id,
            **counts,
            "failed_tickers": failed,
            "quality_passed": summary.get("overall_passed", False),
            "execution_time_seconds": round(elapsed, 1),
            "report": report_path,
            "error": None,
        }
    except Exception as exc:  # noqa: BLE001 - the job records every failure
        elapsed = time.monotonic() - t0
        log.exception("batch %s failed after %.1fs", batch_id, elapsed)
        passed = summary.get("overall_passed") if summary else None
        try:
            write_audit_row(wh, _audit(cfg, started, STATUS_FAILED, counts, passed, str(exc)))
        except Exception:  # noqa: BLE001
            log.exception("could not write the failure audit row")
        return {
            "status": STATUS_FAILED,
            "batch_id": batch_id,
            **counts,
            "failed_tickers": failed,
            "quality_passed": passed,
            "execution_time_seconds": round(elapsed, 1),
            "error": str(exc),
        }
    finally:
        for df in persisted:
            df.unpersist()


def _first_gaps(clean: DataFrame) -> list[dict]:
    """Gap rows for the report, by ticker and date."""
    first = date_gaps(clean).orderBy("ticker", "gap_after").limit(MAX_LISTED_GAPS)
    return [r.asDict() for r in first.withColumn("gap_after", F.col("gap_after").cast("string")).collect()]


def _report(spark, cfg: BatchConfig, summary: dict, counts: dict, t0: float) -> str:
    outcome = {k: summary[k] for k in ("checks", "overall_passed") if k in summary}
    rows = {k: counts[k] for k in ("rows_extracted", "rows_inserted", "rows_skipped")}
    report = QualityReport(cfg.batch_id, **rows, **outcome, execution_time_seconds=time.monotonic() - t0)
    return write_quality_report(spark, report.document(), cfg.reports_dir)


def _audit(cfg: BatchConfig, started, status: str, counts: dict, passed, error) -> dict:
    return {
        "batch_id": cfg.batch_id,
        "started_at": started,
        "completed_at": utc_now(),
        "status": status,
        "tickers": ", ".join(cfg.tickers),
        "rows_extracted": counts["rows_extracted"],
        "rows_inserted": counts["rows_inserted"],
        "rows_skipped": counts["rows_skipped"],
        "quality_checks_passed": passed,
        "error_message": error,
    }


def main(argv: list[str] | None = None) -> int:
    """CLI: run the job over a Parquet source of raw rows; prints the result as
    JSON and exits 1 on failure."""
    from barlake.session import build_session

    p = argparse.ArgumentParser(description="barlake daily batch job")
    p.add_argument("--source", required=True, help="Parquet path of raw rows (Date, Ticker, ...)")
    p.add_argument("--tickers", required=True, help="comma-separated tickers")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--reports", required=True)
    p.add_argument("--bronze")
    p.add_argument("--attributes", help="Parquet path of ticker, company_name, sector, industry")
    p.add_argument("--lookback-days", type=int, default=LOOKBACK_DAYS, help="window for new tickers")
    p.add_argument("--today", help="end of the extract window (YYYY-MM-DD, exclusive); default today")
    p.add_argument("--on-conflict", choices=["skip", "update"], default="skip",
                   help="stored (ticker, day) rows: keep them (default) or apply the batch's values")
    args = p.parse_args(argv)
    spark = build_session()
    cfg = BatchConfig(
        tickers=args.tickers.split(","), warehouse=args.warehouse, reports_dir=args.reports,
        bronze_root=args.bronze,
        lookback_days=args.lookback_days,
        on_conflict=args.on_conflict,
        today=dt.date.fromisoformat(args.today) if args.today else None,
    )
    attrs = spark.read.parquet(args.attributes) if args.attributes else None
    result = run_batch(spark, spark.read.parquet(args.source), cfg, attrs)
    print(json.dumps(result, default=str))
    return 0 if result["status"] == STATUS_SUCCESS else 1


if __name__ == "__main__":
    sys.exit(main())
