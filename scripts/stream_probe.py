"""Run the streaming lane over a whole test table and compare it with the batch twin.

Usage: python scripts/stream_probe.py SF_DIR SCRATCH_DIR [ROWS_PER_SLICE]

Lands the event tick messages (with their injected faults) as ordered text
slices, runs the dead-letter and bar queries with ``availableNow``, then checks
that the dead letters plus the valid ticks are all the input, and that the
stored bars equal the batch bars of the valid ticks for every window the
watermark has closed. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from barlake.operators.bars import ohlcv_bars  # noqa: E402
from barlake.plans import catalog  # noqa: E402
from barlake.session import build_session  # noqa: E402
from barlake.sources import testdata as src  # noqa: E402
from barlake.sources.warehouse import Warehouse  # noqa: E402
from barlake.streaming.landing import land_in_order  # noqa: E402
from barlake.streaming.processor import StreamConfig, start  # noqa: E402


def main() -> None:
    sf_dir, scratch = sys.argv[1], sys.argv[2]
    per_slice = int(sys.argv[3]) if len(sys.argv) > 3 else 10_000
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    msgs = src.tick_messages(spark, sf_dir).withColumn("ordinal", F.col("event_id"))
    t0 = time.perf_counter()
    slices = land_in_order(msgs, f"{scratch}/landing", per_slice)
    landed = time.perf_counter() - t0
    cfg = StreamConfig(
        warehouse=f"{scratch}/wh",
        checkpoint_root=f"{scratch}/ckpt",
        dlq_path=f"{scratch}/dlq",
        landing=f"{scratch}/landing",
        available_now=True,
        max_files_per_trigger=8,
    )
    t0 = time.perf_counter()
    dlq_q, bars_q = start(spark, cfg)
    dlq_q.awaitTermination()
    bars_q.awaitTermination()
    streamed = time.perf_counter() - t0

    valid = catalog.QUERIES["valid_ticks"](spark, sf_dir)
    last = valid.agg(F.max("event_time")).first()[0]
    cols = ["ticker", "window_start", "open", "high", "low", "close", "volume", "tick_count"]
    twin = ohlcv_bars(valid).where(
        F.col("window_end") <= F.lit(last) - F.expr("INTERVAL 30 SECONDS")
    ).select(*cols)
    stored = Warehouse(spark, cfg.warehouse).read("fact_intraday_bars").select(*cols)
    dead = spark.read.json(cfg.dlq_path).count()
    out = {
        "messages": msgs.count(),
        "slices": slices,
        "landing_sec": round(landed, 1),
        "stream_sec": round(streamed, 1),
        "dead_letters": dead,
        "valid": valid.count(),
        "bars": stored.count(),
        "twin_bars": twin.count(),
        "bars_only_in_stream": stored.exceptAll(twin).count(),
        "bars_only_in_twin": twin.exceptAll(stored).count(),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
