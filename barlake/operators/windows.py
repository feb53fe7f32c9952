"""Window building blocks that do not put a whole key into one task.

A plain ``Window.partitionBy(ticker)`` sends every row of a ticker to one task;
if one ticker holds a third of the data, that task holds a third of the data.

* ``previous_in_key``: the previous row per key. Each key is split into calendar
  months; the previous row is found inside a month, and the first and last rows
  of the months (two each, whatever the data size) carry the edges over in a
  second window, which holds at most 2,400 rows per key and century.
* ``trailing_mean``: a range frame ``[t - lookback, t - 1]`` over intraday
  rows, whose count per key is not bounded. Each key is split into time
  buckets; rows within ``lookback`` of a bucket's end are also emitted into
  the next bucket as context ("halo") rows, in the same pass, so each bucket
  sees everything its frames need.
* ``bucketed_ordinal``: consecutive positions in a total order by two-level prefix
  sums: rows are numbered inside declared buckets (a day, the head of a name), and
  the buckets' sizes, one small row each, are summed. Lazy: nothing runs when the
  plan is built.
* ``global_ordinal``: the same without declared buckets: range-partition, sort within
  partitions, then add per-partition offsets (one row per partition, broadcast).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from barlake.functions.prices import exact_mean
from barlake.functions.timecols import epoch_seconds
from barlake.session import checkpoint_dir

SECONDS_PER_DAY = 86400


def previous_in_key(
    df: DataFrame, keys: Sequence[str], order_col: str, carry: Sequence[str], prefix: str = "prev_"
) -> DataFrame:
    """Add ``prefix + c`` for ``order_col`` and each ``carry`` column: the value on the
    previous row of the same key in ``order_col`` order (null on a key's first row).

    ``order_col`` is unique per key; nulls come first. Dates and timestamps are cut
    into months (see the module note); other types take one window per key.
    """
    in_order = F.col(order_col).asc()
    names = [order_col, *carry]
    if not isinstance(df.schema[order_col].dataType, (DateType, TimestampType, TimestampNTZType)):
        whole = Window.partitionBy(*keys).orderBy(in_order)
        return df.select("*", *[F.lag(c).over(whole).alias(f"{prefix}{c}") for c in names])
    month = F.date_trunc("MONTH", order_col)
    piece = Window.partitionBy(*keys, "_month").orderBy(in_order)
    marked = df.withColumn("_month", month).select(
        "*",
        *[F.lag(c).over(piece).alias(f"{prefix}{c}") for c in names],
        F.lag(F.lit(1)).over(piece).isNull().alias("_first"),
        F.lead(F.lit(1)).over(piece).isNull().alias("_last"),
    )
    # the edges of a key meet in one window; other rows stay with their month, so
    # that one plan over one scan serves both
    edge = F.col("_first") | F.col("_last")
    carried = Window.partitionBy(*keys, edge, F.when(~edge, F.col("_month"))).orderBy(in_order)
    return marked.withColumns(
        {
            f"{prefix}{c}": F.when(F.col("_first"), F.lag(c).over(carried)).otherwise(F.col(f"{prefix}{c}"))
            for c in names
        }
    ).drop("_month", "_first", "_last")


def trailing_mean(
    df: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    value_col: str,
    lookback_seconds: int,
    out_col: str,
    bucket_seconds: int = SECONDS_PER_DAY,
) -> DataFrame:
    """``out_col`` = mean of ``value_col`` over rows of the same key whose time lies in
    ``[t - lookback, t - 1 s]`` (null when there are none).

    The mean does not depend on summation order (``prices.exact_mean``).
    """
    if lookback_seconds <= 0:
        raise ValueError("lookback_seconds must be positive")
    bucket_seconds = max(bucket_seconds, lookback_seconds)
    keys = list(keys)
    sec = epoch_seconds(F.col(ts_col))
    bkt = F.floor(sec / bucket_seconds)
    # each row serves its own bucket; rows near a bucket's end also serve the
    # next bucket, as context only (one pass, no second scan of the input)
    near_end = sec >= (bkt + 1) * bucket_seconds - lookback_seconds
    copies = F.when(
        near_end,
        F.array(
            F.struct(bkt.alias("_bkt"), F.lit(False).alias("_ctx")),
            F.struct((bkt + 1).alias("_bkt"), F.lit(True).alias("_ctx")),
        ),
    ).otherwise(F.array(F.struct(bkt.alias("_bkt"), F.lit(False).alias("_ctx"))))
    both = df.select("*", sec.alias("_sec"), F.inline(copies))
    frame = (
        Window.partitionBy(*keys, "_bkt").orderBy("_sec").rangeBetween(-lookback_seconds, -1)
    )
    scored = both.withColumn(out_col, exact_mean(F.col(value_col), frame))
    return scored.where(~F.col("_ctx")).drop("_sec", "_bkt", "_ctx")


def bucketed_ordinal(
    df: DataFrame, order_cols: Sequence[str], bucket: Column, name: str = "ordinal"
) -> DataFrame:
    """Add ``name``: 0-based position of each row in the total order of ``order_cols``.

    ``bucket`` never falls as rows rise in that order, and tells apart parts of a size
    that a task can sort; ``order_cols`` identify rows uniquely. The input is read
    twice, once for the buckets' sizes; both readers compute the same from the same
    rows, so a lost executor changes no position.
    """
    marked = df.withColumn("_bucket", bucket)
    sizes = marked.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_bucket").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")
    )
    inside = F.row_number().over(
        Window.partitionBy("_bucket").orderBy(*[F.col(c).asc() for c in order_cols])
    )
    return (
        marked.withColumn("_inside", inside)
        .join(offsets, F.col("_bucket").eqNullSafe(F.col("_of")))
        .withColumn(name, F.col("_off") + F.col("_inside") - 1)
        .drop("_bucket", "_inside", "_of", "_off")
    )


def global_ordinal(
    df: DataFrame,
    order_cols: Sequence[str],
    name: str = "ordinal",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``name``: 0-based position of each row in the total order of ``order_cols``.

    ``order_cols`` must identify rows uniquely, so the order is total and a
    re-run after a lost executor gives the same numbers.

    The per-partition counts and the rows must come from the same
    range-partitioned data: a second plan of the exchange could sample other
    range bounds. So the tagged rows are checkpointed (eagerly, into the
    session's ``spark.checkpoint.dir``) and both sides read that copy. It also
    cuts the lineage: a lost executor costs a re-read, not a new sort.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    cols = [F.col(c).asc() for c in order_cols]
    # without an explicit count AQE sizes the range partitions (a small dimension
    # becomes one partition); the ids stay consistent because the tagged rows are
    # checkpointed before anything else reads them
    if num_partitions:
        ranged = df.repartitionByRange(num_partitions, *cols)
    else:
        ranged = df.repartitionByRange(*cols)
    ranged = ranged.sortWithinPartitions(*cols)
    tagged = ranged.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_local",
        F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33),
    ).checkpoint(eager=True)
    counts = tagged.groupBy("_pid").agg(F.count("*").alias("_n"))
    # at most n rows: one per partition
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_off"),
    )
    out = tagged.join(F.broadcast(offsets), "_pid", "inner")
    return out.withColumn(name, F.col("_off") + F.col("_local")).drop("_pid", "_local", "_off")
