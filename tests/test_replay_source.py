"""The staged replay: ordinals in order whatever the file times, admission by rate, restarts."""

import os
import time

import pytest
from pyspark.sql import functions as F

from barlake.operators.replay import replay_messages, replay_schedule
from barlake.sources import testdata as src
from barlake.sources.bronze import replay_rows
from barlake.sources.warehouse import Warehouse
from barlake.streaming.processor import StreamConfig, start
from barlake.streaming.replay_source import ReplayReader, read_replay, stage_replay

from .conftest import SF_SMALL


def messages(spark, n):
    return spark.range(n).select(
        F.col("id").alias("ordinal"), F.concat(F.lit("k"), F.col("id") % 3).alias("key"),
        F.concat(F.lit("m"), F.col("id")).alias("value"),
    )


def drain(df, folder, **trigger):
    """Run to the end; the ordinals of each micro-batch as they came."""
    seen = []

    def keep(batch, batch_id):
        seen.append([r["ordinal"] for r in batch.select("ordinal").collect()])

    query = df.writeStream.foreachBatch(keep).option("checkpointLocation", folder).trigger(**trigger).start()
    return query, seen


def test_ordinals_come_in_order_whatever_the_file_times(spark, tmp_path):
    staged = str(tmp_path / "staged")
    stage_replay(messages(spark, 1000).orderBy(F.rand(1)), staged)
    files = [f for f in os.listdir(f"{staged}/messages") if f.endswith(".parquet")]
    for k, name in enumerate(sorted(files, reverse=True)):
        os.utime(f"{staged}/messages/{name}", (1_000_000 + k, 1_000_000 + k))
    query, seen = drain(read_replay(spark, staged), str(tmp_path / "ck"), availableNow=True)
    query.awaitTermination(120)
    assert [x for batch in seen for x in batch] == list(range(1000))
    assert read_replay(spark, staged).schema.names == ["ordinal", "key", "value"]


def test_rate_admits_what_is_due_and_restarts_go_on(spark, tmp_path):
    staged = str(tmp_path / "staged")
    stage_replay(messages(spark, 100_000), staged, rate=100.0)
    paced = read_replay(spark, staged, started=str(time.time() - 2))
    query, seen = drain(paced, str(tmp_path / "ck"), processingTime="300 milliseconds")
    deadline = time.time() + 60
    while len(seen) < 3 and time.time() < deadline:
        time.sleep(0.1)
    query.stop()
    first = [x for batch in seen for x in batch]
    assert len(seen) >= 3 and first == list(range(len(first))) and len(first) >= 200
    rest = read_replay(spark, staged, started=str(time.time() - 3600))
    again = []
    for _ in range(2):  # with a planned batch to finish, availableNow does only that one
        query, more = drain(rest, str(tmp_path / "ck"), availableNow=True)
        query.awaitTermination(120)
        again += [x for batch in more for x in batch]
    # a batch that was not committed is read once more, nothing is left out
    assert again == list(range(again[0], 100_000)) and again[0] <= len(first)


def test_reader_reads_only_what_lies_between_offsets(spark, tmp_path):
    staged = str(tmp_path / "staged")
    stage_replay(messages(spark, 400), staged)
    reader = ReplayReader({"path": staged})
    parts = reader.partitions({"ordinal": 90}, {"ordinal": 110})
    got = [x for p in parts for batch in reader.read(p) for x in batch.column("ordinal").to_pylist()]
    assert got == list(range(90, 110))
    assert all(p.end - p.start <= 20 for p in parts)
    assert reader.partitions({"ordinal": 400}, {"ordinal": 400}) == []


def test_empty_replay_and_bad_rates(spark, tmp_path):
    staged = str(tmp_path / "staged")
    stage_replay(messages(spark, 0), staged)
    assert ReplayReader({"path": staged}).latestOffset() == {"ordinal": 0}
    with pytest.raises(ValueError):
        stage_replay(messages(spark, 1), str(tmp_path / "other"), rate=0)


def test_replay_feeds_the_bars(spark, tmp_path):
    feed = src.price_feed(spark, SF_SMALL).withColumnRenamed("Ticker", "ticker")
    rows = replay_rows(feed, order_col="seq")
    sched = replay_schedule(rows, F.lit("2026-01-01 09:30:00").cast("timestamp_ntz"), 10.0)
    staged = str(tmp_path / "staged")
    stage_replay(replay_messages(sched), staged)
    cfg = StreamConfig(
        warehouse=str(tmp_path / "wh"), checkpoint_root=str(tmp_path / "ck"), dlq_path=str(tmp_path / "dlq"),
        source="replay", landing=staged, trigger="500 milliseconds",
    )
    last = sched.agg(F.max("event_time")).collect()[0][0]
    cut = F.lit(last) - F.expr("INTERVAL 30 SECONDS")
    closed = sched.where(F.date_trunc("minute", "event_time") + F.expr("INTERVAL 1 MINUTE") <= cut).count()
    queries = start(spark, cfg)
    deadline, in_bars = time.time() + 120, None
    while in_bars != closed and time.time() < deadline:
        time.sleep(2)
        in_bars = Warehouse(spark, cfg.warehouse).read("fact_intraday_bars").agg(F.sum("tick_count")).first()[0]
    for query in queries:
        query.stop()
    assert in_bars == closed > 0
