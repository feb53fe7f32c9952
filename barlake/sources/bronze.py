"""Bronze layer: raw extracts landed as Parquet before any transform.

Layout ``<root>/ticker=T/year=Y/batch_id=B/part-*.parquet``: partition discovery
gives the ticker back on read, filters on ticker or year prune folders, and a
rerun of the same batch replaces only its own folders (dynamic partition
overwrite), so a retried write is idempotent.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.schemas import BRONZE_TARGETS

log = logging.getLogger(__name__)


def resolve_bronze_root(
    target: str,
    local_dir: str | None = None,
    container: str = "bronze",
    account: str | None = None,
) -> str:
    """Root URI for the Bronze target: ``local`` -> a folder, ``azure`` -> an
    ``abfss://`` URI (needs the storage account). Anything else is an error."""
    if target == "local":
        if not local_dir:
            raise ValueError("local Bronze target needs a directory")
        return local_dir
    if target == "azure":
        if not account:
            raise ValueError(
                "azure Bronze target needs a storage account (connection settings missing)"
            )
        return f"abfss://{container}@{account}.dfs.core.windows.net"
    raise ValueError(f"no Bronze target called {target!r}; choose one of {BRONZE_TARGETS}")


def with_partitions(raw: DataFrame, year_mode: str = "row", date_col: str = "Date") -> DataFrame:
    """Add ``ticker`` and ``year`` partition values to a flat raw extract.

    ``year_mode="row"``: each row's own year (pruning stays right).
    ``year_mode="extract"``: the latest year of the ticker's extract for all its
    rows (the reference's file naming); computed as a per-ticker aggregate joined
    back, not as a window over a whole ticker.
    """
    out = raw.withColumn("ticker", F.col("Ticker")) if "ticker" not in raw.columns else raw
    year = F.year(F.col(date_col))
    if year_mode == "row":
        return out.withColumn("year", F.coalesce(year, F.year(F.current_date())))
    if year_mode == "extract":
        latest = out.groupBy("ticker").agg(F.max(year).alias("year"))
        out = out.join(latest, "ticker", "left")
        return out.withColumn("year", F.coalesce(F.col("year"), F.year(F.current_date())))
    raise ValueError(f"year_mode must be 'row' or 'extract', not {year_mode!r}")


def write_bronze(raw: DataFrame, root: str, batch_id: str, year_mode: str = "row") -> str:
    """Land the raw extract under ``root``; returns the root. Raises on failure."""
    staged = with_partitions(raw, year_mode).withColumn("batch_id", F.lit(batch_id))
    if "Ticker" in staged.columns:
        staged = staged.drop("Ticker")
    (
        staged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ticker", "year", "batch_id")
        .parquet(root)
    )
    return root


def write_bronze_safely(raw: DataFrame, root: str, batch_id: str, year_mode: str = "row") -> bool:
    """A Bronze failure must not lose the extract: log it and go on."""
    try:
        write_bronze(raw, root, batch_id, year_mode)
        return True
    except Exception:  # noqa: BLE001 - any storage error is non-fatal here
        log.exception("Bronze write failed for batch %s; continuing", batch_id)
        return False


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    """All Bronze files; ticker/year/batch_id come back from the folder names.

    Adds ``landed_at`` (file modification time) so readers can prefer the
    latest batch for a (ticker, date).
    """
    df = spark.read.option("basePath", root).parquet(root)
    return df.withColumn("landed_at", F.col("_metadata.file_modification_time"))


def replay_rows(bronze: DataFrame, order_col: str | None = "landed_at", dedupe: bool = True) -> DataFrame:
    """Bronze -> (ticker, Date, price, volume): rows without a close dropped; with
    ``dedupe`` one row per (ticker, Date), the latest by ``order_col``."""
    rows = bronze.where(F.col("Close").isNotNull()).select(
        "ticker",
        "Date",
        F.col("Close").alias("price"),
        F.coalesce(F.col("Volume").cast("bigint"), F.lit(0)).alias("volume"),
        *([F.col(order_col)] if order_col and order_col in bronze.columns else []),
    )
    if not dedupe or not order_col or order_col not in rows.columns:
        return rows.select("ticker", "Date", "price", "volume")
    last = rows.groupBy("ticker", "Date").agg(
        F.max_by(F.struct("price", "volume"), F.col(order_col)).alias("_r")
    )
    return last.select("ticker", "Date", "_r.price", "_r.volume")


def require_rows(df: DataFrame, root: str) -> DataFrame:
    if df.isEmpty():
        raise FileNotFoundError(f"no Bronze files under {root}; land an extract first")
    return df
