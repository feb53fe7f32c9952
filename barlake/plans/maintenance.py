"""Scheduled maintenance: fold small files left by appends and micro-batches.

    python -m barlake.plans.maintenance --warehouse W --fact-years 2025 2026 \
        --bar-days-before 2026-01-05 --bar-days 7

Fact years are rewritten in place (staged, then swapped by dynamic partition
overwrite). Bar days are only compacted when they are closed: older than
``--bar-days-before``, which should lie behind the stream's watermark plus its
reference lookback. Staging goes under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import uuid

from barlake.session import build_session, checkpoint_dir, join_path
from barlake.sources.warehouse import Warehouse, compact_partitions
from barlake.streaming.processor import compact_day


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="barlake maintenance (compaction)")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--fact-years", type=int, nargs="*", default=[])
    p.add_argument("--bar-days-before", help="compact bar days strictly before this date (YYYY-MM-DD)")
    p.add_argument("--bar-days", type=int, default=1, help="how many days before that date")
    a = p.parse_args(argv)
    spark = build_session(app_name="barlake-maintenance")
    wh = Warehouse(spark, a.warehouse)
    stage_root = join_path(checkpoint_dir(spark), f"compact-{uuid.uuid4().hex}")
    done: dict[str, int] = {}
    if a.fact_years:
        done["fact_rows"] = compact_partitions(
            wh, "fact_stock_prices", "price_year", a.fact_years, join_path(stage_root, "fact")
        )
    if a.bar_days_before:
        end = dt.date.fromisoformat(a.bar_days_before)
        for k in range(1, a.bar_days + 1):
            day = end - dt.timedelta(days=k)
            for table in ("fact_intraday_bars", "alerts"):
                key = f"{table}:{day.isoformat()}"
                done[key] = compact_day(wh, table, day, join_path(stage_root, key.replace(":", "-")))
    print(json.dumps(done))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
