"""Structured Streaming: JSON ticks -> dead letters + 1-minute bars -> warehouse.

Two queries read the same source:

1. dead letters: messages failing validation, written raw with their reason;
2. bars: valid ticks -> 30 s event-time watermark -> 1-minute tumbling
   window per ticker (append mode: a bar is emitted once, when final) ->
   ``foreachBatch`` sink that skips bars already stored, adds the trailing
   reference average, writes bars and price-move alerts.

The sink is set-based (joins and windows on DataFrames, nothing collected but
one min timestamp) and idempotent: each micro-batch writes its own partitions
``bar_date=<day>/stream_id=<id>/batch_id=<n>`` with dynamic overwrite, so a retried batch
replaces its own output. ``stream_id`` lives beside the checkpoint; a new
checkpoint gets a new id, so restarted batch numbers never overwrite old data.
Alerts are written before bars: a crash between the two leaves the bars
missing, so the retry recomputes both.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barlake.functions.ticks import with_tick_check
from barlake.functions.timecols import ntz_literal
from barlake.operators.bars import ohlcv_bars, price_alerts, with_reference_average
from barlake.schemas import (
    ALERT_THRESHOLD_PCT,
    BAR_WIDTH,
    DLQ_TOPIC,
    REFERENCE_LOOKBACK_SECONDS,
    TICK_TOPIC,
    TRIGGER_INTERVAL,
    WATERMARK_DELAY,
)
from barlake.session import ensure_utc, join_path
from barlake.sources.warehouse import Warehouse, is_missing_path
from barlake.streaming.monitor import progress_folder, save_progress
from barlake.streaming.replay_source import read_replay


# bar_date first: the sink reads back only the last lookback of stored bars,
# which then prunes to one or two date folders
SINK_PARTITIONS = ["bar_date", "stream_id", "batch_id"]


# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------


def read_messages(
    spark: SparkSession,
    source: str = "files",
    path: str | None = None,
    bootstrap: str | None = None,
    topic: str = TICK_TOPIC,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame with one string column ``raw`` per message.

    ``files``: a landing folder of text files, one JSON message per line
    (read in file modification order). ``replay``: a staged replay, read in the
    order of its ordinals at its own rate. ``kafka``: the tick topic from the
    earliest offset (needs the Kafka connector on the classpath).
    """
    if source == "replay":
        return read_replay(spark, path).select(F.col("value").alias("raw"))
    if source == "files":
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.load(path).select(F.col("value").alias("raw"))
    if source == "kafka":
        return (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .load()
            .select(F.col("value").cast("string").alias("raw"))
        )
    raise ValueError(f"unknown tick source {source!r} (expected 'files', 'replay' or 'kafka')")


def valid_ticks(messages: DataFrame) -> DataFrame:
    """Valid messages as typed ticks; event_time is a TIMESTAMP (the watermark needs it)."""
    ok = with_tick_check(messages, "raw").where(F.col("reason") == "ok")
    return ok.select(
        F.col("t_ticker").alias("ticker"),
        F.col("t_price").alias("price"),
        F.col("t_volume").alias("volume"),
        F.col("t_event_time").cast("timestamp").alias("event_time"),
    )


def dead_letters(messages: DataFrame) -> DataFrame:
    """Invalid messages, raw text kept, with the reason. The reason is never null,
    so every message lands on exactly one side."""
    checked = with_tick_check(messages, "raw")
    return checked.where(F.col("reason") != "ok").select(F.col("raw").alias("value"), "reason")


def stream_bars(ticks: DataFrame, watermark: str = WATERMARK_DELAY, width: str = BAR_WIDTH) -> DataFrame:
    """Watermarked tumbling-window bars; window bounds returned as naive UTC."""
    bars = ohlcv_bars(ticks.withWatermark("event_time", watermark), width)
    return bars.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).withColumn(
        "window_end", F.col("window_end").cast("timestamp_ntz")
    )


# ---------------------------------------------------------------------------
# Sink
# ---------------------------------------------------------------------------


PROGRESS_SECONDS = 30  # how often the stream's progress is saved for the monitor


class BarSink:
    """``foreachBatch`` function: dedupe, score, write bars + alerts, record metrics."""

    def __init__(
        self,
        warehouse: Warehouse,
        stream_id: str,
        threshold_pct: float = ALERT_THRESHOLD_PCT,
        lookback_seconds: int = REFERENCE_LOOKBACK_SECONDS,
    ):
        self.wh = warehouse
        self.stream_id = stream_id
        self.threshold = threshold_pct
        self.lookback = lookback_seconds

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        bars = batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._write(bars, batch_id)
        finally:
            bars.unpersist()

    def _write(self, bars: DataFrame, batch_id: int) -> None:
        span = bars.agg(
            F.min("window_start").alias("lo"), F.max("window_start").alias("hi"), F.count("*").alias("n")
        ).first()
        first, last, bars_in = span["lo"], span["hi"], span["n"]
        if first is None:
            return
        spark = bars.sparkSession
        now = F.localtimestamp().cast("timestamp_ntz")
        lower = F.timestamp_add("SECOND", F.lit(-self.lookback), ntz_literal(first))
        # read back only the bar_date folders that can hold the tail or a duplicate
        start_day = (first - dt.timedelta(seconds=self.lookback)).date()
        days = [start_day + dt.timedelta(days=k) for k in range((last.date() - start_day).days + 1)]
        stored = self.wh.read_partitions("fact_intraday_bars", "bar_date", days)
        # a retried batch must not see its own earlier output
        mine = (F.col("stream_id") == self.stream_id) & (F.col("batch_id") == batch_id)
        if "stream_id" in stored.columns:
            stored = stored.where(~F.coalesce(mine, F.lit(False)))
        tail = stored.where(F.col("window_start") >= lower).select("ticker", "window_start", "close")

        new = bars.join(tail.select("ticker", "window_start"), ["ticker", "window_start"], "left_anti")
        context = tail.withColumn("_new", F.lit(False))
        fresh = new.select("ticker", "window_start", "close").withColumn("_new", F.lit(True))
        scored_keys = with_reference_average(context.unionByName(fresh), self.lookback).where("_new")
        scored = new.join(
            scored_keys.select("ticker", "window_start", "reference_avg", "avg_close_5min"),
            ["ticker", "window_start"],
        ).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            tag = [
                F.to_date("window_start").alias("bar_date"),
                F.lit(self.stream_id).alias("stream_id"),
                F.lit(batch_id).cast("bigint").alias("batch_id"),
            ]
            alerts = price_alerts(scored, self.threshold, created_at=now).select("*", *tag)
            # a retry that raises no alert on some day must not leave the old ones there
            for day in days:
                own = {"bar_date": day.isoformat(), "stream_id": self.stream_id, "batch_id": batch_id}
                self.wh.drop_partition("alerts", own)
            alert_obs = Observation(f"alerts_{batch_id}")
            self.wh.overwrite_partitions(
                "alerts", alerts.observe(alert_obs, F.count(F.lit(1)).alias("n")), SINK_PARTITIONS
            )
            out = scored.withColumn("processed_at", now).select("*", *tag)
            bar_obs = Observation(f"bars_{batch_id}")
            self.wh.overwrite_partitions(
                "fact_intraday_bars", out.observe(bar_obs, F.count(F.lit(1)).alias("n")), SINK_PARTITIONS
            )
            inserted = bar_obs.get["n"]
            metrics = spark.createDataFrame(
                [(self.stream_id, batch_id, bars_in, inserted, bars_in - inserted, alert_obs.get["n"])],
                self.wh.schemas["bar_metrics"],
            )
            self.wh.append("bar_metrics", metrics)
        finally:
            scored.unpersist()


# ---------------------------------------------------------------------------
# Job
# ---------------------------------------------------------------------------


@dataclass
class StreamConfig:
    warehouse: str
    checkpoint_root: str
    dlq_path: str
    source: str = "files"
    landing: str | None = None
    bootstrap: str | None = None
    trigger: str = TRIGGER_INTERVAL
    available_now: bool = False
    max_files_per_trigger: int | None = None
    threshold_pct: float = ALERT_THRESHOLD_PCT
    lookback_seconds: int = REFERENCE_LOOKBACK_SECONDS
    watermark: str = WATERMARK_DELAY
    width: str = BAR_WIDTH
    dlq_format: str = "json"
    # state partitions are fixed by the first checkpoint: size them for the
    # cluster up front (the reference's dev stack used 4); None = session value
    state_partitions: int | None = None
    # RocksDB keeps window state off the JVM heap (large state, many tickers)
    rocksdb_state: bool = True


def stream_id_for(spark: SparkSession, checkpoint_root: str) -> str:
    """Id kept beside the checkpoint; created with it."""
    path = join_path(checkpoint_root, "stream_id")
    try:
        rows = spark.read.text(path).collect()
        if rows:
            return rows[0][0].strip()
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
    sid = uuid.uuid4().hex
    spark.createDataFrame([(sid,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return sid


def start(spark: SparkSession, cfg: StreamConfig, tracker=None):
    """Start the dead-letter and bar queries; returns (dlq_query, bars_query).

    ``tracker`` (a ``monitor.ProgressTracker``) is registered as a query
    listener first, so health checks can read lag from the progress events.
    """
    ensure_utc(spark)  # event times are naive UTC; windows align to UTC minutes
    if tracker is not None:
        spark.streams.addListener(tracker)
    if cfg.state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(cfg.state_partitions))
    if cfg.rocksdb_state:
        spark.conf.set(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    wh = Warehouse(spark, cfg.warehouse)
    wh.ensure_tables(["fact_intraday_bars", "alerts", "bar_metrics"])
    messages = read_messages(
        spark, cfg.source, cfg.landing, cfg.bootstrap, max_files_per_trigger=cfg.max_files_per_trigger
    )

    def trig(w):
        return w.trigger(availableNow=True) if cfg.available_now else w.trigger(processingTime=cfg.trigger)

    dlq = dead_letters(messages)
    if cfg.source == "kafka":
        dlq_writer = (
            dlq.select("value").writeStream.format("kafka")
            .option("kafka.bootstrap.servers", cfg.bootstrap)
            .option("topic", DLQ_TOPIC)
        )
    else:
        dlq_writer = dlq.writeStream.format(cfg.dlq_format).option("path", cfg.dlq_path)
    dlq_query = trig(
        dlq_writer.option("checkpointLocation", join_path(cfg.checkpoint_root, "dlq")).queryName("dead_letters")
    ).start()

    sink = BarSink(wh, stream_id_for(spark, join_path(cfg.checkpoint_root, "bars_meta")),
                   cfg.threshold_pct, cfg.lookback_seconds)
    bars = stream_bars(valid_ticks(messages), cfg.watermark, cfg.width)
    bars_query = trig(
        bars.writeStream.outputMode("append")
        .foreachBatch(sink)
        .option("checkpointLocation", join_path(cfg.checkpoint_root, "bars"))
        .queryName("intraday_bars")
    ).start()
    return dlq_query, bars_query


def main(argv: list[str] | None = None) -> None:
    import argparse

    from barlake.session import build_session

    p = argparse.ArgumentParser(description="barlake tick stream processor")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--checkpoints", required=True)
    p.add_argument("--dlq", required=True)
    p.add_argument("--source", default="files", choices=["files", "replay", "kafka"])
    p.add_argument("--landing", help="landing folder, or the folder of a staged replay")
    p.add_argument("--bootstrap")
    p.add_argument("--threshold", type=float, default=ALERT_THRESHOLD_PCT)
    p.add_argument("--state-partitions", type=int, help="shuffle/state partitions (fixed per checkpoint)")
    a = p.parse_args(argv)
    spark = build_session(app_name="barlake-stream")
    queries = start(spark, StreamConfig(a.warehouse, a.checkpoints, a.dlq, a.source, a.landing, a.bootstrap,
                                        threshold_pct=a.threshold, state_partitions=a.state_partitions))
    while not spark.streams.awaitAnyTermination(PROGRESS_SECONDS):
        save_progress(spark, queries, progress_folder(a.checkpoints))


if __name__ == "__main__":
    main()


# ---------------------------------------------------------------------------
# Compaction
# ---------------------------------------------------------------------------

COMPACTED_STREAM = "compacted"


def compact_day(wh: Warehouse, table: str, day: dt.date, staging: str) -> int:
    """Rewrite one closed day of a sink table as a single folder of large files.

    Each micro-batch leaves its own ``bar_date/stream_id/batch_id`` folder, so a
    day at 30 s triggers holds thousands of small ones. Once no micro-batch can
    touch the day any more (it is older than the watermark plus the reference
    lookback), its rows are staged in a shared folder and then written back over
    the day as ``stream_id=compacted/batch_id=0``. Returns the rows kept.
    """
    base = wh.path(table)
    rows = wh.read_partitions(table, "bar_date", [day])
    declared = wh.schemas[table].fieldNames()
    rows = rows.select(*declared)
    rows.write.mode("overwrite").parquet(staging)
    staged = wh.spark.read.schema(wh.schemas[table]).parquet(staging)
    n = staged.count()
    if n == 0:
        return 0
    (
        staged.withColumn("stream_id", F.lit(COMPACTED_STREAM))
        .withColumn("batch_id", F.lit(0).cast("bigint"))
        .repartition(max(1, n // 1_000_000 + 1))
        .sortWithinPartitions("ticker", "window_start")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")  # replace the whole day folder
        .partitionBy("stream_id", "batch_id")
        .parquet(join_path(base, f"bar_date={day.isoformat()}"))
    )
    return n
