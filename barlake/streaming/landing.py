"""Publishing replayed tick messages: a landing folder for the file source, a staged
replay for the ``replay`` source, or Kafka.

The file source reads files in modification-time order. One job writes all slices of
consecutive ordinals, a file each, to a hidden folder; then the files are given
modification times in slice order and moved into the landing folder one after the
other, so a stream that already reads it sees them in event-time order too. That needs
a file system that keeps modification times (local, HDFS). ``replay_source`` needs
none: its offsets are the ordinals themselves.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators.replay import replay_messages, replay_schedule
from barlake.schemas import REPLAY_SPEED, TICK_TOPIC
from barlake.session import join_path
from barlake.sources.bronze import read_bronze, replay_rows
from barlake.streaming.replay_source import stage_replay


def land_in_order(messages: DataFrame, landing: str, rows_per_slice: int) -> int:
    """Write ``messages`` (with ``ordinal`` and ``value``) as text files of
    ``rows_per_slice`` consecutive ordinals; returns the number of files."""
    if rows_per_slice <= 0:
        raise ValueError("rows_per_slice must be positive")
    spark = messages.sparkSession
    hidden = join_path(landing, f"_slices-{uuid.uuid4().hex}")
    (
        messages.select("value", "ordinal", F.expr(f"ordinal div {int(rows_per_slice)}").alias("slice"))
        .repartition("slice")
        .sortWithinPartitions("slice", "ordinal")
        .drop("ordinal")
        .write.partitionBy("slice")
        .text(hidden)
    )
    return _move_in_order(spark, hidden, landing)


def _move_in_order(spark: SparkSession, hidden: str, landing: str) -> int:
    """Files of ``hidden/slice=k`` go to ``landing``, times rising with k. Names only: a
    file is one metadata call, and nothing is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(hidden).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    slices = sorted(
        (int(s.getPath().getName().removeprefix("slice=")), s.getPath())
        for s in fs.listStatus(path(hidden))
        if s.isDirectory()
    )
    run = uuid.uuid4().hex
    # the newest file gets the present time, the others a millisecond less each
    first = int(time.time() * 1000) - len(slices)
    for k, (number, folder) in enumerate(slices):
        (part,) = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")]
        fs.setTimes(part, first + k, -1)
        if not fs.rename(part, path(join_path(landing, f"part-{number:012d}-{run}.txt"))):
            raise OSError(f"cannot move slice {number} into {landing}")
    fs.delete(path(hidden), True)
    return len(slices)


def replay_bronze(spark: SparkSession, bronze: str, t0: Column, rate: float = REPLAY_SPEED) -> DataFrame:
    """Bronze rows of a root as paced tick messages."""
    return replay_messages(replay_schedule(replay_rows(read_bronze(spark, bronze)), t0, rate))


def publish_kafka(messages: DataFrame, bootstrap: str, topic: str = TICK_TOPIC) -> None:
    """Keyed messages (``key``, ``value``) to a Kafka topic (needs the connector jar)."""
    (
        messages.select(F.col("key").cast("string"), F.col("value").cast("string"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("topic", topic)
        .save()
    )


def main(argv: list[str] | None = None) -> int:
    """Replay Bronze: to a landing folder, to a staged replay, or to Kafka."""
    import argparse

    from barlake.session import build_session

    p = argparse.ArgumentParser(description="barlake replay")
    p.add_argument("--bronze", required=True)
    p.add_argument("--rate", type=float, default=REPLAY_SPEED, help="ticks per second of event time")
    p.add_argument("--start", help="event time of the first tick; default now")
    p.add_argument("--landing", help="folder of text files for the file source")
    p.add_argument("--staged", help="folder of a staged replay for the replay source")
    p.add_argument("--rows-per-slice", type=int, default=1_000_000)
    p.add_argument("--bootstrap")
    p.add_argument("--topic", default=TICK_TOPIC)
    a = p.parse_args(argv)
    if sum(map(bool, (a.landing, a.staged, a.bootstrap))) != 1:
        p.error("give one of --landing, --staged and --bootstrap")
    spark = build_session(app_name="barlake-replay")
    t0 = (F.lit(a.start) if a.start else F.localtimestamp()).cast("timestamp_ntz")
    messages = replay_bronze(spark, a.bronze, t0, a.rate)
    if a.landing:
        land_in_order(messages, a.landing, a.rows_per_slice)
    elif a.staged:
        stage_replay(messages, a.staged, a.rate)
    else:
        publish_kafka(messages, a.bootstrap, a.topic)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
