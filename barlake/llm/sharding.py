"""Hierarchical weighted hash tree: rows descend region, rack and shard.

At every level each child of the current node draws ``-ln(u) / weight`` with
``u`` hashed from the row's key and the child's name, and the smallest draw
wins. A child's draw depends on nothing but its own name and weight, so a change
of one weight moves rows only to or from the children whose weights change: rows
of other subtrees stay where they are.

Defined cases: a null key is a key of its own (all null keys meet in one shard);
rows that repeat a key follow it; an empty table gives an empty table; columns of
the input stay, whatever their names, unless they bear the name of the result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from barlake.llm.common import fresh, table, written

RANK_BUCKETS = 1024
BASE_SHARDS = 16


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def balanced_tree(shards: int, regions: int = 2, racks: int = 2) -> list[Leaf]:
    """``shards`` equal shards dealt over ``regions`` x ``racks``."""
    per_rack = max(1, -(-shards // (regions * racks)))
    return [
        Leaf(f"g{s // per_rack // racks}", f"k{s // per_rack}", s) for s in range(shards)
    ]


def grown(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard, as a region of its own.

    No existing node changes its weight, so the only draw that is new is the new
    region's: rows move into the new shard and nowhere else.
    """
    shard = max((leaf.shard for leaf in tree), default=-1) + 1
    return [*tree, Leaf(f"region-of-{shard}", f"rack-of-{shard}", shard, weight)]


def tree_of(shards: int) -> list[Leaf]:
    """The tree for a number of shards, which alone decides it.

    From ``BASE_SHARDS`` on every tree is the one before it with one more shard, so
    going from any such number to the next moves rows into the new shard only. A
    smaller number has a balanced tree of its own.
    """
    tree = balanced_tree(min(shards, BASE_SHARDS))
    while len(tree) < shards:
        tree = grown(tree)
    return tree


def _draw(key: Column, name: str, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11)
    unit = (bits.cast("double") + F.lit(0.5)) * F.lit(2.0**-53)
    return -F.log(unit) / F.lit(float(weight))


def _descend(key: Column, leaves: list[Leaf], levels: tuple[str, ...], prefix: str) -> Column:
    """Shard of ``key`` below one node; the children are told apart by ``levels[0]``."""
    children: dict = {}
    for leaf in leaves:
        children.setdefault(getattr(leaf, levels[0]), []).append(leaf)
    draws = [
        F.struct(
            _draw(key, f"{prefix}/{name}", sum(x.weight for x in below)).alias("draw"),
            F.lit(i).alias("child"),
        )
        for i, (name, below) in enumerate(children.items())
    ]
    winner = F.array_min(F.array(*draws))["child"] if len(draws) > 1 else F.lit(0)
    result: Column | None = None
    for i, (name, below) in enumerate(children.items()):
        deeper = (
            F.lit(below[0].shard)
            if len(levels) == 1
            else _descend(key, below, levels[1:], f"{prefix}/{name}")
        )
        result = F.when(winner == i, deeper) if result is None else result.when(winner == i, deeper)
    return result


def shard_of(key: Column, tree: list[Leaf]) -> Column:
    """Shard number of a key; leaves without weight take nothing."""
    live = [leaf for leaf in tree if leaf.weight > 0]
    if not live:
        raise ValueError("no shard has a weight above 0")
    return _descend(key, live, ("region", "rack", "shard"), "").cast("int")


def gapless_slots(
    df: DataFrame, group: str, order: list[str], name: str = "slot", buckets: int = RANK_BUCKETS
) -> DataFrame:
    """Number the rows of each group from 0 without gaps, no group in one task.

    Rows of a group are spread over hash buckets of their ``order`` columns. Equal
    rows are spread once more, by a hash of their row number (stored, so that all
    readers see the same), into pieces that are counted before they are numbered:
    a row's slot is the size of the buckets before, plus that of the pieces before
    in its bucket, plus its rank in its piece. ``order`` must tell different rows
    apart; equal rows take any order.
    The offsets table has at most groups x ``buckets`` rows and is broadcast
    under that bound (the caller's groups are a fixed number of shards).
    """
    bucket, salt, rank, before, inside, rows = fresh(
        df, "bucket", "salt", "rank", "before", "inside", "rows"
    )
    piece = [group, bucket, *order, salt]
    of = fresh(df, *[f"of{k}" for k in range(len(piece))])
    row_number = F.monotonically_increasing_id()
    stored = written(
        df.withColumns(
            {
                bucket: F.pmod(F.xxhash64(*order), F.lit(buckets)),
                salt: F.pmod(F.xxhash64(row_number), F.lit(buckets)),
            }
        ),
        "salted",
    )
    ranked = stored.withColumn(rank, F.row_number().over(Window.partitionBy(*piece).orderBy(salt)))
    count = F.count(F.lit(1)).alias(rows)

    def rows_before(window: WindowSpec) -> Column:
        earlier = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(rows).over(earlier), F.lit(0))

    in_bucket = stored.groupBy(*piece).agg(count).select(
        *[F.col(c).alias(o) for c, o in zip(piece, of)],
        rows_before(Window.partitionBy(group, bucket).orderBy(*order, salt)).alias(inside),
    )
    offsets = stored.groupBy(group, bucket).agg(count).select(
        group, bucket, rows_before(Window.partitionBy(group).orderBy(bucket)).alias(before)
    )
    same = [F.col(c).eqNullSafe(F.col(o)) for c, o in zip(piece, of)]
    return (
        ranked.join(in_bucket, same)
        .join(F.broadcast(offsets), [group, bucket])
        .withColumn(name, (F.col(before) + F.col(inside) + F.col(rank) - 1).cast("long"))
        .select(*df.columns, *([] if name in df.columns else [name]))
    )


def op7_query(spark: SparkSession, sf_dir: str, shards: int = 16) -> DataFrame:
    """Shard of every document by its id, its slot there, and the shard after growth."""
    tree, larger = tree_of(shards), tree_of(shards + 1)
    text = F.col("text")
    placed = table(spark, sf_dir, "documents").select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), tree).alias("shard"),
        shard_of(F.col("doc_id"), larger).alias("grown_shard"),
    )
    # stores the narrow rows, so the texts are read once
    ranked = gapless_slots(placed, "shard", ["doc_id", "size", "text_crc32"])
    return ranked.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
