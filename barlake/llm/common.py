"""Helpers shared by the training-data operators."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barlake.session import checkpoint_dir, join_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(join_path(sf_dir, f"{name}.parquet"))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let executors import this package from a zip that Spark hands out, once an application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="barlake-zip-")
    zipped = shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name)
    context.addPyFile(zipped)
    _shipped.add(context.applicationId)


def _stored(df: DataFrame, name: str) -> tuple[DataFrame, Path]:
    spark = df.sparkSession
    path = join_path(checkpoint_dir(spark), f"barlake-{name}-{uuid.uuid4().hex}")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    _file_system(spark, hadoop).deleteOnExit(hadoop)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), hadoop


def _file_system(spark: SparkSession, hadoop):
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored as a table in the shared checkpoint folder and read back.

    Cuts the lineage in a way that outlives any executor: later reads come from
    the shared folder. The table is removed when the application's file system
    closes.
    """
    return _stored(df, name)[0]


class Rewritten:
    """A table that is stored again and again; only the newest copy stays."""

    def __init__(self, name: str):
        self._name, self._old = name, None

    def store(self, df: DataFrame) -> DataFrame:
        kept, path = _stored(df, self._name)
        if self._old is not None:
            _file_system(df.sparkSession, self._old).delete(self._old, True)
        self._old = path
        return kept


def sampled(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """About the ``rows`` rows of ``df`` with the smallest hash of ``key``, never more.

    A threshold on the hash, from one count, drops nearly all others where they
    are; only about 1.2 x ``rows`` rows are sorted.
    """
    place = F.shiftrightunsigned(F.xxhash64(*key), 11)  # 53 bits, evenly spread
    total = df.count()
    if total > rows:
        share = min(1.0, (1.2 * rows + 100) / total)
        df = df.where(place < int(share * 2**53))
    return df.orderBy(place, *key).limit(rows)


def appended(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """``batch`` with ``columns`` put after its own, which stay as they are."""
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *columns.values()], names=[*batch.schema.names, *columns]
    )


def extended(df: DataFrame, more: str) -> StructType:
    """Schema of ``df`` with the columns of the DDL string ``more`` after its own."""
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Working column names that no column of ``df`` has (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def id_held_out(doc_id: Column) -> Column:
    """Rows kept away from training: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
