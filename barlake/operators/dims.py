"""Dimensions: the date calendar and the company dimension upsert."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.timecols import date_id
from barlake.operators.windows import bucketed_ordinal
from barlake.schemas import DIM_COMPANY, DIM_DATE, DIM_DATE_END, DIM_DATE_START


def date_attributes(day: Column) -> list[Column]:
    """The dim_date columns for a midnight ``TIMESTAMP_NTZ`` column."""
    weekday = F.weekday(day)  # 0 = Monday
    return [
        date_id(day).alias("date_id"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),  # ISO week
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (weekday >= 5).alias("is_weekend"),
    ]


def date_dimension(
    spark: SparkSession, start: str = DIM_DATE_START, end: str = DIM_DATE_END
) -> DataFrame:
    """One row per calendar day in ``[start, end]`` (2000-2035 = 13,149 rows).

    Generated with ``spark.range`` so the days are spread over tasks.
    """
    d0 = dt.date.fromisoformat(start)
    n = (dt.date.fromisoformat(end) - d0).days + 1
    days = spark.range(n).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int"))
        .cast("timestamp_ntz")
        .alias("d")
    )
    return days.select(*date_attributes(F.col("d"))).select(
        *[F.col(f.name).cast(f.dataType) for f in DIM_DATE.fields]
    )


def empty_dim_company(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DIM_COMPANY)


def upsert_dim_company(
    existing: DataFrame, tickers: DataFrame, info: DataFrame, now: Column
) -> DataFrame:
    """The whole dimension after an upsert.

    * tickers not yet present are inserted with their attributes (nulls when
      the source has none) and new ids ``max(id) + 1, +2, ...`` in ticker order;
    * a present ticker whose stored name is null gets name, sector and industry
      replaced when the source has a non-empty name; ``updated_at`` moves then;
    * every other row is kept as it is.

    ``tickers`` has a ``ticker`` column; ``info`` has ticker, company_name,
    sector, industry (at most one row per ticker).
    """
    want = tickers.select("ticker").where(F.col("ticker").isNotNull()).distinct()
    attrs = want.join(info, "ticker", "left")
    cur = existing.alias("e")
    new = attrs.alias("n")
    both = cur.join(new, F.col("e.ticker") == F.col("n.ticker"), "full_outer")

    is_new = F.col("e.ticker").isNull()
    fill = (
        F.col("e.ticker").isNotNull()
        & F.col("e.company_name").isNull()
        & F.col("n.company_name").isNotNull()
        & (F.col("n.company_name") != "")
    )

    def pick(c: str) -> Column:
        return F.when(is_new | fill, F.col(f"n.{c}")).otherwise(F.col(f"e.{c}"))

    merged = both.select(
        F.col("e.company_id").alias("company_id"),
        F.coalesce(F.col("e.ticker"), F.col("n.ticker")).alias("ticker"),
        pick("company_name").alias("company_name"),
        pick("sector").alias("sector"),
        pick("industry").alias("industry"),
        F.when(is_new, now).otherwise(F.col("e.created_at")).alias("created_at"),
        F.when(is_new | fill, now).otherwise(F.col("e.updated_at")).alias("updated_at"),
        is_new.alias("_new"),
    )
    kept = merged.where(~F.col("_new")).drop("_new")
    added = assign_surrogate_keys(merged.where(F.col("_new")).drop("_new"), existing)
    out = kept.unionByName(added)
    return out.select(*[F.col(f.name).cast(f.dataType) for f in DIM_COMPANY.fields])


def ticker_bucket() -> Column:
    """Head of a ticker: rises with the ticker's order."""
    return F.substring("ticker", 1, 2)


def assign_surrogate_keys(new_rows: DataFrame, existing: DataFrame, key: str = "company_id") -> DataFrame:
    """Ids ``max(existing) + 1 + position`` for new rows in ticker order.

    Positions are counted inside buckets of the tickers' first two letters, so no
    single task numbers all rows; the max id is a scalar subquery.
    """
    base = existing.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint")).scalar()
    ranked = bucketed_ordinal(new_rows.drop(key), ["ticker"], ticker_bucket(), "_pos")
    return ranked.withColumn(key, base + F.col("_pos") + 1).drop("_pos")


def backfill_company_id(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """Set ``company_id`` where it is null, by ticker (migration step)."""
    ids = dim.select("ticker", F.col("company_id").alias("_cid"))
    out = facts.join(ids, "ticker", "left")
    return out.withColumn("company_id", F.coalesce(F.col("company_id"), F.col("_cid"))).drop("_cid")
