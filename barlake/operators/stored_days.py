"""Stored days as bitmaps: which (ticker, day) keys a fact holds, a few KB per ticker.

A bitmap covers 32,768 days (89 years), so a ticker has one or two. They are built by
one aggregate that collapses a ticker's rows before the shuffle, merge by OR, and are
kept beside the fact (``Warehouse`` table ``stored_days``), so that a load tests one
bit per row instead of joining with, or scanning, stored history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 0001-01-01 is day 1: every valid date has a positive number
_DAY_ONE = 719163
_BITS = 32768


def day_number(time: Column) -> Column:
    return F.unix_date(time.cast("date")).cast("bigint") + F.lit(_DAY_ONE)


def day_bitmaps(keys: DataFrame) -> DataFrame:
    """(ticker, bucket, days) of rows with ticker and price_date; null keys are not stored."""
    day = day_number(F.col("price_date"))
    numbered = keys.where(F.col("ticker").isNotNull() & F.col("price_date").isNotNull()).select(
        "ticker", F.bitmap_bucket_number(day).alias("bucket"), F.bitmap_bit_position(day).alias("bit")
    )
    return numbered.groupBy("ticker", "bucket").agg(F.bitmap_construct_agg("bit").alias("days"))


def merged_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """One row per (ticker, bucket): all its bitmaps together."""
    return bitmaps.groupBy("ticker", "bucket").agg(F.bitmap_or_agg("days").alias("days"))


def _byte(days: Column, position: Column) -> Column:
    digits = F.hex(F.substring(days, position + 1, F.lit(1)))
    return F.coalesce(F.conv(digits, 16, 10).cast("int"), F.lit(0))


def with_stored(rows: DataFrame, bitmaps: DataFrame, name: str) -> DataFrame:
    """``rows`` with the boolean ``name``: whether the row's (ticker, day) is stored.

    The join is on (ticker, bucket), unique on the bitmaps' side.
    """
    day = day_number(F.col("price_date"))
    bit = F.bitmap_bit_position(day)
    sides = bitmaps.select(
        F.col("ticker").alias("_bt"), F.col("bucket").alias("_bb"), F.col("days").alias("_days")
    )
    joined = rows.withColumn("_bucket", F.bitmap_bucket_number(day)).join(
        sides, (F.col("ticker") == F.col("_bt")) & (F.col("_bucket") == F.col("_bb")), "left"
    )
    mask = F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (bit % 8 + 1).cast("int"))
    found = _byte(F.col("_days"), F.floor(bit / 8).cast("int")).bitwiseAND(mask) != 0
    return joined.select(
        *[rows[c] for c in rows.columns], F.coalesce(F.col("_days").isNotNull() & found, F.lit(False)).alias(name)
    )


def stored_keys(bitmaps: DataFrame) -> DataFrame:
    """(ticker, price_date) of every bit: the stored days, as midnights."""
    places = F.filter(
        F.sequence(F.lit(0), F.lit(_BITS // 8 - 1)),
        lambda k: F.substring("days", k + 1, F.lit(1)) != F.lit(b"\x00"),
    )
    bytes_set = bitmaps.select("ticker", "bucket", "days", F.explode(places).alias("k"))
    each = bytes_set.select("ticker", "bucket", "k", _byte(F.col("days"), F.col("k")).alias("byte"))
    bits = F.filter(
        F.sequence(F.lit(0), F.lit(7)), lambda b: F.get(F.split(F.lpad(F.bin("byte"), 8, "0"), ""), 7 - b) == "1"
    )
    number = (F.col("bucket") - 1) * _BITS + F.col("k") * 8 + F.col("b") + 1
    return each.select("ticker", "bucket", "k", F.explode(bits).alias("b")).select(
        "ticker",
        F.date_from_unix_date((number - _DAY_ONE).cast("int")).cast("timestamp_ntz").alias("price_date"),
    )
