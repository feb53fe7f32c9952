"""Load into the price fact: enrich, skip stored keys, count.

Stored keys are bitmaps of days per ticker (``stored_days``): a few KB a ticker, so
a load joins its rows with one bitmap each and tests a bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, IntegralType

from barlake.functions.timecols import date_id, day_start
from barlake.operators.stored_days import day_bitmaps, merged_bitmaps, stored_keys, with_stored
from barlake.schemas import FACT_STOCK_PRICES

KEYS = ["ticker", "price_date"]


def last_stored_dates(facts: DataFrame, tickers: DataFrame | None = None) -> DataFrame:
    """Latest stored day per ticker (as a DATE); tickers without rows are absent."""
    f = facts.select("ticker", "price_date")
    if tickers is not None:
        f = f.join(tickers.select("ticker").distinct(), "ticker", "left_semi")
    return (
        f.groupBy("ticker")
        .agg(F.max("price_date").cast("date").alias("last_date"))
        .where(F.col("last_date").isNotNull())
    )


def existing_keys(facts: DataFrame, tickers: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Stored (ticker, day) keys, restricted to the given tickers.

    With ``days`` (the fact's bitmaps) the facts themselves are not read.
    """
    bitmaps = day_bitmaps(facts) if days is None else merged_bitmaps(days)
    return stored_keys(bitmaps.join(tickers.select("ticker").distinct(), "ticker", "left_semi"))


def daily_rows(batch: DataFrame) -> DataFrame:
    """One row per (ticker, day): the latest time of the day, of equal times the
    latest arrival (``seq``); price_date becomes the day. Without ``seq`` equal
    times are told apart by the row's values, so a re-run keeps the same row."""
    others = [c for c in batch.columns if c not in KEYS]
    arrival = ["seq"] if "seq" in batch.columns else others
    day = day_start(F.col("price_date"))
    latest = F.max_by(F.struct(*others), F.struct("price_date", *arrival)).alias("row")
    kept = batch.groupBy("ticker", day.alias("price_date")).agg(latest)
    return kept.select(*[F.col(c) if c in KEYS else F.col(f"row.{c}") for c in batch.columns])


def enrich_facts(batch: DataFrame, dim_company: DataFrame, batch_id: str) -> DataFrame:
    """One row per (ticker, day) with company_id (left lookup), date_id and batch_id."""
    ids = dim_company.select("ticker", "company_id")
    return (
        daily_rows(batch).join(ids, "ticker", "left")
        .withColumn("date_id", date_id(F.col("price_date")))
        .withColumn("batch_id", F.lit(batch_id))
    )


def _stored_keys(stored: DataFrame, since=None) -> DataFrame:
    """Stored (ticker, day) keys, optionally only from day ``since`` on.

    A batch only covers recent days, so ``since`` (the batch's first day, as a
    literal) keeps the years of history out of the join: the filter reaches the
    Parquet scan, which skips files whose price_date statistics end earlier.
    """
    if since is not None:
        stored = stored.where(F.col("price_date") >= F.lit(str(since)).cast("timestamp_ntz"))
        if "price_year" in stored.columns:  # the warehouse's year folders
            stored = stored.where(F.col("price_year") >= int(str(since)[:4]))
    return stored.select("ticker", day_start(F.col("price_date")).alias("price_date"))


def batch_first_day(enriched: DataFrame):
    """Earliest day of a batch (one small aggregate)."""
    return enriched.agg(F.min("price_date")).first()[0]


def _stored_days(stored: DataFrame, since, days: DataFrame | None) -> DataFrame:
    return day_bitmaps(_stored_keys(stored, since)) if days is None else merged_bitmaps(days)


def new_rows(
    enriched: DataFrame, stored: DataFrame, since=None, days: DataFrame | None = None
) -> DataFrame:
    """Rows whose (ticker, day) is not stored yet.

    Tested against bitmaps of the stored days: ``days`` (kept beside the fact), or
    those of ``stored``, whose rows collapse to them before any shuffle.
    """
    flagged = with_stored(enriched, _stored_days(stored, since, days), "_stored")
    return flagged.where(~F.col("_stored")).drop("_stored")


def load_counts(
    enriched: DataFrame, stored: DataFrame, since=None, days: DataFrame | None = None
) -> DataFrame:
    """One row: rows in the batch, inserted (new keys) and skipped (stored keys)."""
    flagged = with_stored(enriched.select(*KEYS), _stored_days(stored, since, days), "_stored")
    return flagged.agg(
        F.count("*").alias("rows_in_batch"),
        F.count_if(~F.col("_stored")).alias("rows_inserted"),
        F.count_if(F.col("_stored")).alias("rows_skipped"),
    )


def to_fact_schema(rows: DataFrame) -> DataFrame:
    """Project and cast to the stored fact schema (missing columns become null).

    A whole-number column takes whole numbers only: a volume of 12.5 is stored as null,
    never as 12, and the check ``column_types`` reports the batch.
    """
    cols = []
    for f in FACT_STOCK_PRICES.fields:
        c: Column = F.col(f.name) if f.name in rows.columns else F.lit(None)
        stored = c.cast(f.dataType)
        given = rows.schema[f.name].dataType if f.name in rows.columns else f.dataType
        if isinstance(f.dataType, IntegralType) and isinstance(given, FractionalType):
            stored = F.when(c == F.floor(c), c.try_cast(f.dataType))
        cols.append(stored.alias(f.name))
    return rows.select(*cols)


def merge_rows(enriched: DataFrame, stored: DataFrame) -> DataFrame:
    """Late corrections (``on_conflict="update"``): the stored rows of the batch's
    years without the batch's keys, plus every batch row. Written back over
    those years' partitions, a stored (ticker, day) takes the batch's values."""
    years = [r[0] for r in enriched.select(F.year("price_date")).distinct().collect()]  # the batch span
    keep = stored.where(F.year("price_date").isin(years)) if years else stored.limit(0)
    if "price_year" in keep.columns and years:
        keep = keep.where(F.col("price_year").isin(years))  # prunes the year folders
    kept = keep.join(enriched.select(*KEYS), KEYS, "left_anti")
    return to_fact_schema(kept).unionByName(to_fact_schema(enriched))
