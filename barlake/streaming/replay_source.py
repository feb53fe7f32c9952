"""Replay as a streaming source whose offset is the ordinal.

``stage_replay`` writes the messages once: Parquet files, each a sorted range of
ordinals, an index of the files' first and last ordinals (a row per file) and the
replay's clock. The source ``barlake_replay`` then admits by rate: at any moment the
messages with ``ordinal < (now - started) * rate`` are due, so a stream that was down
catches up and a restart needs no memory of its own; without a rate all are due.
A trigger reads the ordinals between two offsets: a task per file that holds some, in
order, and only the row groups that overlap. File times and listing order play no part.

Tasks read with pyarrow, so the staged folder's scheme must be one that pyarrow opens
(local paths, ``file``, ``hdfs``, ``s3``, ``gs``, ``abfs``), and executors need this
package installed.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from barlake.session import join_path

SOURCE = "barlake_replay"
SCHEMA = "ordinal bigint, key string, value string"


def stage_replay(
    messages: DataFrame, path: str, rate: float | None = None, started: float | None = None
) -> None:
    """Write ``messages`` (ordinal, key, value) for the source; ordinals are unique.

    ``rate``: messages a second from ``started`` (epoch seconds, default now) on.
    """
    if rate is not None and not rate > 0:
        raise ValueError("the replay rate (ticks per second) must be above zero")
    spark = messages.sparkSession
    files = join_path(path, "messages")
    (
        messages.select("ordinal", "key", "value")
        .repartitionByRange("ordinal")
        .sortWithinPartitions("ordinal")
        .write.parquet(files)
    )
    spans = (
        spark.read.parquet(files)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.min("ordinal").alias("first"), F.max("ordinal").alias("last"))
    )
    spans.coalesce(1).write.parquet(join_path(path, "index"))
    # the clock comes last: a folder without one is not a staged replay yet
    clock = json.dumps({"rate": rate, "started": time.time() if started is None else started})
    spark.createDataFrame([(clock,)], "clock string").coalesce(1).write.parquet(join_path(path, "clock"))


def read_replay(spark: SparkSession, path: str, **options) -> DataFrame:
    """The staged replay as a streaming DataFrame (ordinal, key, value)."""
    spark.dataSource.register(ReplaySource)
    return spark.readStream.format(SOURCE).options(path=path, **options).load()


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _table(path: str):
    fs, inner = _opened(path)
    return ds.dataset(inner, filesystem=fs, format="parquet").to_table()


class ReplaySource(DataSource):
    """Options: ``path``; ``rate`` and ``started`` take the place of the staged clock."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return ReplayReader(self.options)


@dataclass
class OrdinalRange(InputPartition):
    file: str
    start: int
    end: int


class ReplayReader(DataSourceStreamReader):
    """Offsets are ``{"ordinal": n}``: all messages before n have been read."""

    def __init__(self, options):
        path = options["path"]
        (clock,) = _table(join_path(path, "clock")).column("clock").to_pylist()
        staged = json.loads(clock)
        rate = options.get("rate", staged["rate"])
        self.rate = None if rate is None else float(rate)
        self.started = float(options.get("started", staged["started"]))
        spans = _table(join_path(path, "index")).to_pylist()
        self.spans = sorted((s["first"], s["last"], s["file"]) for s in spans)
        self.total = max((last + 1 for _, last, _ in self.spans), default=0)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"ordinal": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        if self.rate is None:
            return {"ordinal": self.total}
        due = int((time.time() - self.started) * self.rate)
        return {"ordinal": max(0, min(self.total, due))}

    def partitions(self, start: dict, end: dict) -> list[OrdinalRange]:
        low, high = start["ordinal"], end["ordinal"]
        return [
            OrdinalRange(file, max(low, first), min(high, last + 1))
            for first, last, file in self.spans
            if first < high and last >= low
        ]

    def read(self, partition: OrdinalRange) -> Iterator:
        fs, inner = _opened(partition.file)
        file = pq.ParquetFile(inner, filesystem=fs)
        ordinal = file.schema_arrow.get_field_index("ordinal")
        groups = []
        for k in range(file.num_row_groups):
            seen = file.metadata.row_group(k).column(ordinal).statistics
            if seen is None or (seen.min < partition.end and seen.max >= partition.start):
                groups.append(k)
        # one batch after the other: memory holds a batch, not the file
        for batch in file.iter_batches(row_groups=groups, columns=["ordinal", "key", "value"]):
            field = ds.field("ordinal")
            rows = batch.filter((field >= partition.start) & (field < partition.end))
            if rows.num_rows:
                yield rows
