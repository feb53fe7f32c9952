"""Schema migration v1 -> v2 of the price fact, as Spark jobs.

Steps: add company_id, date_id, batch_id when missing; backfill date_id where
null; add the fact's distinct tickers to dim_company; backfill company_id
where null. Idempotent: a second run changes nothing. Spark cannot overwrite
a table it is reading, so results go to a new version path and a pointer
file is switched (see ``barlake.sources.warehouse``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.timecols import date_id
from barlake.operators.dims import backfill_company_id, empty_dim_company, upsert_dim_company

NEW_COLUMNS = {"company_id": "bigint", "date_id": "int", "batch_id": "string"}


def add_missing_columns(facts: DataFrame) -> DataFrame:
    for name, dtype in NEW_COLUMNS.items():
        if name not in facts.columns:
            facts = facts.withColumn(name, F.lit(None).cast(dtype))
    return facts


def migrate_frames(
    facts_v1: DataFrame, dim_company: DataFrame | None, now: Column
) -> tuple[DataFrame, DataFrame]:
    """Return (migrated facts, dim_company after adding the fact tickers)."""
    facts = add_missing_columns(facts_v1)
    facts = facts.withColumn(
        "date_id", F.coalesce(F.col("date_id"), date_id(F.col("price_date")))
    )
    spark: SparkSession = facts.sparkSession
    dim = dim_company if dim_company is not None else empty_dim_company(spark)
    tickers = facts.select("ticker").where(F.col("ticker").isNotNull()).distinct()
    no_info = tickers.select(
        "ticker",
        F.lit(None).cast("string").alias("company_name"),
        F.lit(None).cast("string").alias("sector"),
        F.lit(None).cast("string").alias("industry"),
    )
    dim = upsert_dim_company(dim, tickers, no_info, now)
    return backfill_company_id(facts, dim), dim


def migrate(spark: SparkSession, warehouse_root: str, now: Column | None = None) -> dict:
    """Run the migration against a warehouse folder; returns counts."""
    from barlake.sources.warehouse import Warehouse

    wh = Warehouse(spark, warehouse_root)
    wh.ensure_tables()
    stamp = now if now is not None else F.localtimestamp().cast("timestamp_ntz")
    facts, dim = migrate_frames(wh.read("fact_stock_prices"), wh.read("dim_company"), stamp)
    wh.replace("dim_company", dim)
    wh.replace("fact_stock_prices", facts)
    return {"companies": wh.read("dim_company").count()}
