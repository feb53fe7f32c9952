"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default = the headline set below), BENCH_REPEAT (default 2;
the best of N runs of each query is reported, which damps JIT warm-up and machine noise).

Each query is run to completion with the ``noop`` sink (every row is computed,
nothing is collected). A small warm-up query runs first so JVM start-up is not
charged to the first timed query.
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barlake.plans import catalog  # noqa: E402
from barlake.session import build_session  # noqa: E402

HEADLINE = [
    "intraday_bars",
    "bar_reference_avg",
    "price_alerts",
    "clean_prices",
    "dq_summary",
    "dq_date_gaps",
    "new_rows",
    "load_counts",
    "dim_company_upsert",
    "dead_letters",
    "replay_schedule",
    "latest_close",
    "return_30d",
    "volume_matrix",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    # Spark's own event log (no UI): per-query shuffle and input bytes
    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR") or tempfile.mkdtemp(prefix="barlake-bench-")
    spark = build_session(
        f"local[{cpus}]",
        app_name="barlake-bench",
        shuffle_partitions=cpus * 2,
        extra_conf={
            "spark.driver.memory": "16g",
            "spark.sql.files.maxPartitionBytes": "64m",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{log_dir}",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    catalog.QUERIES["intraday_bars_1h"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        best = None
        spark.sparkContext.setJobGroup(name, name)
        for _ in range(repeat):
            t0 = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)

    # the host's speed: a fixed amount of work on no table, for comparing runs
    t0 = time.perf_counter()
    spark.range(200_000_000).selectExpr("sum(id % 7 * (id & 3))").collect()
    calibration = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    total = round(sum(times.values()), 3)
    out = {
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeat": repeat,
        "calibration_sec": calibration,
        "rows": {"events": events, "orders": orders},
        "rows_per_sec": {
            "events_bars_ref_alerts": round(
                events / max(1e-9, times.get("price_alerts", float("nan"))), 1
            )
            if "price_alerts" in times
            else None,
            "orders_clean": round(orders / max(1e-9, times["clean_prices"]), 1)
            if "clean_prices" in times
            else None,
        },
    }
    spark.stop()
    try:
        shuffle = shuffle_by_query(log_dir)
        # per run: each query's job group covers all of its repeats
        out["shuffle_bytes"] = {n: shuffle.get(n, 0) // repeat for n in names}
        out["event_log"] = log_dir
    except Exception as exc:  # noqa: BLE001 - accounting must not cost the result line
        out["io_error"] = str(exc)[:200]
    print(json.dumps(out))


def _event_lines(log_dir: str):
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if not os.path.isfile(path) or os.path.basename(path).startswith("appstatus"):
            continue
        if path.endswith(".zstd"):
            import zstandard

            with open(path, "rb") as fh:
                text = zstandard.ZstdDecompressor().stream_reader(fh).read().decode("utf-8")
            yield from text.splitlines()
        else:
            with open(path, encoding="utf-8") as fh:
                yield from fh


def shuffle_by_query(log_dir: str) -> dict[str, int]:
    """Sum the shuffle bytes written of each job group from the event log.

    (Spark's input bytes are left out: its Parquet reader does not count column
    chunks that it reads vectored.)
    """
    stage_group: dict[int, str] = {}
    shuffle: dict[str, int] = {}
    for line in _event_lines(log_dir):
        if not line.strip():
            continue
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in ev.get("Stage IDs", []):
                if group:
                    stage_group[sid] = group
        elif kind == "SparkListenerTaskEnd":
            group = stage_group.get(ev.get("Stage ID"))
            metrics = ev.get("Task Metrics") or {}
            if group:
                w = (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                shuffle[group] = shuffle.get(group, 0) + int(w)
    return shuffle


if __name__ == "__main__":
    main()
