"""Parquet warehouse: the star-schema tables of ``barlake.schemas`` under one root.

Layout: ``<root>/<table>/v=<version>/...`` plus ``<root>/<table>/_commits``, a
text table with one line per committed version; the last one is live. Appends add
files to the live version. ``replace`` (dimension upserts, migrations) writes a
new version and then appends its commit line, because Spark cannot overwrite a
table it is reading. Nothing is ever overwritten on the way, so a run that breaks
between any two steps leaves the earlier version live.
``overwrite_partitions`` replaces only the partitions present in the new data
(dynamic partition overwrite), which makes retried micro-batches idempotent.
Everything goes through Spark readers and writers, so the root can be a
shared file system or an object-store URI.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DateType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

from barlake.schemas import PIPELINE_RUNS, QUALITY_RESULTS, REPORT_FILE, WAREHOUSE_TABLES
from barlake.operators.stored_days import day_bitmaps
from barlake.session import join_path

QUALITY_TABLE = StructType(QUALITY_RESULTS.fields + [StructField("batch_id", StringType(), True)])
BAR_METRICS = StructType(
    [
        StructField("stream_id", StringType(), True),
        StructField("batch_id", LongType(), True),
        StructField("bars_in", LongType(), True),
        StructField("inserted", LongType(), True),
        StructField("skipped", LongType(), True),
        StructField("alerts", LongType(), True),
    ]
)
DATE_GAPS = StructType(
    [
        StructField("batch_id", StringType(), True),
        StructField("ticker", StringType(), True),
        StructField("gap_after", TimestampNTZType(), True),
        StructField("gap_calendar_days", LongType(), True),
    ]
)
FAILED_TICKERS = StructType(
    [StructField("batch_id", StringType(), True), StructField("ticker", StringType(), True)]
)
# bitmaps of the price fact's (ticker, day) keys by load: written before the fact, and
# counted once the load has an "end" row (see ``fact_days``)
STORED_DAYS = StructType(
    [
        StructField("load", StringType(), True),
        StructField("batch_id", StringType(), True),
        StructField("state", StringType(), True),
        StructField("ticker", StringType(), True),
        StructField("bucket", LongType(), True),
        StructField("days", BinaryType(), True),
    ]
)
EXTRA_TABLES = {
    "stored_days": STORED_DAYS,
    "quality_results": QUALITY_TABLE,
    "bar_metrics": BAR_METRICS,
    "date_gaps": DATE_GAPS,
    "failed_tickers": FAILED_TICKERS,
}

# Storage-only partition columns. The price fact is appended daily and read back
# by date range, so it is split by year; the stream sink tables carry the
# partitions that make retried micro-batches idempotent (see streaming.processor).
_SINK_PARTS = [
    StructField("bar_date", DateType(), True),
    StructField("stream_id", StringType(), True),
    StructField("batch_id", LongType(), True),
]
STORAGE_PARTITIONS: dict[str, list[StructField]] = {
    "fact_stock_prices": [StructField("price_year", IntegerType(), True)],
    "fact_intraday_bars": _SINK_PARTS,
    "alerts": _SINK_PARTS,
}
# tables that are never swapped to a new version (see Warehouse.current_version)
FIXED_VERSION_TABLES = frozenset({"fact_intraday_bars", "alerts", "bar_metrics"})
# how appends derive the partition values of a table (sink tables bring their own)
PARTITION_VALUES = {"fact_stock_prices": {"price_year": lambda: F.year("price_date")}}
# rows are sorted within each written partition (a local sort, no shuffle), so
# Parquet row-group statistics on these columns are tight and filters skip groups
SORT_WITHIN = {
    "fact_stock_prices": ["ticker", "price_date"],
    "fact_intraday_bars": ["ticker", "window_start"],
    "alerts": ["ticker", "window_start"],
}


def is_missing_path(error: AnalysisException) -> bool:
    """Whether a read failed for the one reason that means "nothing there"."""
    return error.getCondition() == "PATH_NOT_FOUND"


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, StructType] | None = None):
        self.spark = spark
        self.root = root
        self.schemas = dict(WAREHOUSE_TABLES)
        self.schemas.update(EXTRA_TABLES)
        if schemas:
            self.schemas.update(schemas)
        # live version of the stream sink tables, read once per instance: they are
        # only appended to or partition-overwritten, never swapped to a new version,
        # so the pointer cannot change under a running stream
        self._versions: dict[str, str] = {}

    # -- layout -----------------------------------------------------------------
    def _table_dir(self, name: str) -> str:
        return join_path(self.root, name)

    def _commits(self, name: str) -> str:
        return join_path(self._table_dir(name), "_commits")

    def current_version(self, name: str, fresh: bool = False) -> str | None:
        if not fresh and name in self._versions and name in FIXED_VERSION_TABLES:
            return self._versions[name]
        try:
            latest = self.spark.read.text(self._commits(name)).agg(F.max(F.trim("value"))).first()[0]
        except AnalysisException as error:
            if not is_missing_path(error):
                raise
            return None
        if latest is not None:
            self._versions[name] = latest
        return latest

    def path(self, name: str) -> str:
        version = self.current_version(name)
        if version is None:
            raise FileNotFoundError(f"table {name} does not exist under {self.root}")
        return join_path(self._table_dir(name), f"v={version}")

    def _set_version(self, name: str, version: str) -> None:
        line = self.spark.createDataFrame([(version,)], "value string").coalesce(1)
        line.write.mode("append").text(self._commits(name))
        self._versions[name] = version

    # -- lifecycle ----------------------------------------------------------------
    def exists(self, name: str) -> bool:
        return self.current_version(name) is not None

    def ensure_tables(self, names: list[str] | None = None) -> None:
        """Create every missing table as an empty Parquet table; existing ones are kept.

        A table without a commit but with files of some version is not created
        over: what is there has to be looked at first.
        """
        for name in names or list(self.schemas):
            if self.exists(name):
                continue
            if self._has_rows(name):
                raise RuntimeError(f"table {name} under {self.root} has files but no committed version")
            self._write_version(name, self.spark.createDataFrame([], self.schemas[name]), "0")
            self._set_version(name, "0")

    def _has_rows(self, name: str) -> bool:
        """Whether any version folder of the table holds rows, committed or not."""
        try:
            found = self._reader(name).option("recursiveFileLookup", "true").parquet(
                join_path(self._table_dir(name), "v=*")
            )
            return not found.isEmpty()
        except AnalysisException as error:
            if not is_missing_path(error):
                raise
            return False

    def read(self, name: str) -> DataFrame:
        """The live version, projected to the declared schema (extra storage columns,
        such as sink partitions, are kept after the declared ones)."""
        return self._project(name, self._reader(name).parquet(self.path(name)))

    def storage_schema(self, name: str) -> StructType:
        return StructType(self.schemas[name].fields + STORAGE_PARTITIONS.get(name, []))

    def _reader(self, name: str):
        # explicit schema: no inference, and an empty partitioned table reads as empty
        return self.spark.read.schema(self.storage_schema(name))

    def read_partitions(self, name: str, column: str, values: list) -> DataFrame:
        """Only the ``column=value`` folders of a partitioned table (a path glob, so
        nothing else is listed); an empty frame with the table schema when none exist."""
        base = self.path(name)
        if values:
            glob = join_path(base, f"{column}={{{','.join(str(v) for v in values)}}}")
            try:
                df = self._reader(name).option("basePath", base).parquet(glob)
                return self._project(name, df)
            except AnalysisException as error:
                if not is_missing_path(error):
                    raise
        return self._project(name, self.spark.createDataFrame([], self.schemas[name]))

    def _project(self, name: str, df: DataFrame) -> DataFrame:
        schema = self.schemas[name]
        cols = [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
        extra = [c for c in df.columns if c not in schema.fieldNames()]
        return df.select(*cols, *extra)

    def is_empty(self, name: str) -> bool:
        return self.read(name).isEmpty()

    # -- writes -------------------------------------------------------------------
    def _conform(self, name: str, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        schema = self.schemas[name]
        cols = [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
        return df.select(*cols, *[F.col(k) for k in keep])

    def _with_partitions(self, name: str, df: DataFrame):
        derive = PARTITION_VALUES.get(name, {})
        out = self._conform(name, df)
        for col, fn in derive.items():
            out = out.withColumn(col, fn())
        if name in SORT_WITHIN:
            out = out.sortWithinPartitions(*list(derive), *SORT_WITHIN[name])
        return out, list(derive)

    def append(self, name: str, df: DataFrame) -> None:
        out, parts = self._with_partitions(name, df)
        writer = out.write.mode("append")
        if parts:
            writer = writer.partitionBy(*parts)
        writer.parquet(self.path(name))

    def _write_version(self, name: str, df: DataFrame, version: str) -> None:
        out, parts = self._with_partitions(name, df)
        writer = out.write.mode("overwrite")
        if parts:
            writer = writer.partitionBy(*parts)
        writer.parquet(join_path(self._table_dir(name), f"v={version}"))

    def replace(self, name: str, df: DataFrame) -> str:
        """Write ``df`` as a new version, then point the table at it."""
        if name in FIXED_VERSION_TABLES:
            raise ValueError(f"{name} is append-only; compact it with compact_day instead")
        version = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S") + "-" + uuid.uuid4().hex[:8]
        self._write_version(name, df, version)
        self._set_version(name, version)
        return version

    def overwrite_partitions(self, name: str, df: DataFrame, partition_cols: list[str]) -> None:
        """Replace exactly the partitions present in ``df`` (idempotent retries)."""
        out = self._conform(name, df, tuple(partition_cols))
        if name in SORT_WITHIN:
            out = out.sortWithinPartitions(*partition_cols, *SORT_WITHIN[name])
        (
            out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_cols)
            .parquet(self.path(name))
        )


    def drop_partition(self, name: str, values: dict) -> None:
        """Delete one partition folder, if it is there (a retried batch's own output)."""
        folder = join_path(self.path(name), *[f"{k}={v}" for k, v in values.items()])
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


ROWS_PER_FILE = 4_000_000


def replace_partitions_via(
    wh: "Warehouse", name: str, rows: DataFrame, staging: str, rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Replace whole partitions of a partitioned table with ``rows``.

    Spark cannot overwrite a path it is reading, and ``rows`` is usually
    derived from those very partitions, so they are first written to
    ``staging`` (a shared folder) and then swapped in by a second job with
    dynamic partition overwrite: only the partitions present in ``rows`` change.
    The second write is range-partitioned on (partition, sort columns) into
    about ``rows_per_file`` rows per task, so files are large, contiguous and
    do not overlap (tight row-group statistics).
    """
    out, parts = wh._with_partitions(name, rows)
    if not parts:
        raise ValueError(f"{name} is not partitioned")
    out.write.mode("overwrite").partitionBy(*parts).parquet(staging)
    staged = wh.spark.read.schema(wh.storage_schema(name)).parquet(staging)
    order = [*parts, *SORT_WITHIN.get(name, [])]
    tasks = max(1, -(-staged.count() // rows_per_file))
    (
        staged.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(wh.path(name))
    )


def compact_partitions(wh: "Warehouse", name: str, column: str, values: list, staging: str) -> int:
    """Rewrite the named partitions of an appended table (daily appends leave many
    small files in the current year) as a few large, sorted files. Returns the
    rows rewritten; the table's contents do not change."""
    rows = wh.read(name).where(F.col(column).isin(values))
    n = rows.count()
    if n:
        replace_partitions_via(wh, name, rows, staging)
    return n


def audit_row(spark: SparkSession, audit: dict) -> DataFrame:
    """One-row DataFrame in the pipeline_runs schema; run_id is a hash of batch_id."""
    row = {f.name: audit.get(f.name) for f in PIPELINE_RUNS.fields}
    df = spark.createDataFrame([row], PIPELINE_RUNS)
    return df.withColumn("run_id", F.abs(F.xxhash64("batch_id")))


class DaysLog:
    """Logs one load's keys: its bitmaps before the fact is written, "end" after it."""

    def __init__(self, wh: Warehouse, batch_id: str, rows: DataFrame):
        self.wh, self.batch_id, self.rows = wh, batch_id, rows
        self.load = uuid.uuid4().hex

    def __enter__(self):
        bitmaps = day_bitmaps(self.rows).withColumns(
            {"load": F.lit(self.load), "batch_id": F.lit(self.batch_id), "state": F.lit("days")}
        )
        self.wh.append("stored_days", bitmaps)
        return self

    def __exit__(self, kind, error, trace):
        if kind is None:
            self.mark(self.load, "end")

    def mark(self, load: str, state: str) -> None:
        row = [(load, self.batch_id, state)]
        self.wh.append("stored_days", self.wh.spark.createDataFrame(row, "load string, batch_id string, state string"))


def fact_days(wh: Warehouse) -> DataFrame:
    """Bitmaps of all (ticker, day) keys of the price fact, without scanning the fact.

    Only what the log lacks is made from the fact: all of it where there is no log yet
    (a warehouse from before it), and the batches of loads that began and did not end.
    """
    log, facts = wh.read("stored_days"), wh.read("fact_stock_prices")
    if log.isEmpty():
        with DaysLog(wh, "initial", facts):
            pass
    else:
        closed = log.where("state <> 'days'").select("load")
        # loads that broke off since the last one that did not: mostly none
        for load, batch_id in log.join(closed, "load", "left_anti").select("load", "batch_id").distinct().collect():
            with DaysLog(wh, batch_id, facts.where(F.col("batch_id") == batch_id)) as made_good:
                made_good.mark(load, "void")
    log = wh.read("stored_days")
    ended = log.where("state = 'end'").select("load").distinct()
    return log.where("state = 'days'").join(ended, "load", "left_semi").select("ticker", "bucket", "days")


def write_audit_row(wh: Warehouse, audit: dict) -> None:
    wh.append("pipeline_runs", audit_row(wh.spark, audit))


@dataclass
class QualityReport:
    """What a run leaves for its readers; field names are the report's keys."""

    batch_id: str
    rows_extracted: int
    rows_inserted: int
    rows_skipped: int
    execution_time_seconds: float
    checks: dict = field(default_factory=dict)
    overall_passed: bool = False
    timestamp: str = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc).isoformat())

    def __post_init__(self) -> None:
        self.execution_time_seconds = round(self.execution_time_seconds, 3)

    def document(self) -> dict:
        return asdict(self)


def write_quality_report(spark: SparkSession, report: dict, reports_dir: str) -> str:
    """``quality_report_<batch_id>.json`` under ``reports_dir``.

    A local folder gets a plain file; a URI gets a one-row text table written by
    Spark (the report is small: nine checks).
    """
    name = REPORT_FILE.format(batch_id=report["batch_id"])
    text = json.dumps(report, indent=2, default=str)
    if "://" in reports_dir and not reports_dir.startswith("file://"):
        target = join_path(reports_dir, name)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(target)
        return target
    folder = reports_dir.removeprefix("file://")
    os.makedirs(folder, exist_ok=True)
    target = os.path.join(folder, name)
    with open(target, "w", encoding="utf-8") as fh:
        fh.write(text)
    return target


def append_jdbc(
    df: DataFrame, url: str, table: str, batch_size: int = 500, options: dict | None = None
) -> None:
    """Append rows to a relational table through Spark's JDBC writer, in insert
    batches of ``batch_size`` rows (the relational warehouse of the reference).

    Each task writes its own partition over its own connection; the table must
    exist. Deduplicate against stored keys first (``load.new_rows``)."""
    writer = (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", str(batch_size))
    )
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    writer.mode("append").save()
