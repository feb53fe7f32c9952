"""Connected components of an edge table by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import Rewritten


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); the root is the smallest node.

    Each round hangs every node's larger neighbours, then its smaller ones, on
    its smallest neighbour, until all hang on their roots: the number of rounds
    grows with the logarithm of the longest path. Each round's edges are a table
    in the shared folder, and only their count and checksum reach the driver.
    """
    large_store, small_store = Rewritten("large-star"), Rewritten("small-star")
    edges = small_store.store(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b").distinct()
    )
    before = None
    while (state := _digest(edges)) != before:
        before = state
        # every node's larger neighbours move to its smallest neighbour or itself
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("m")
        )
        large = (
            both.join(lowest, both["a"] == lowest["node"]).where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = large_store.store(large)
        # every node and its smaller neighbours move to the smallest of them
        lowest = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), "m")
        small = (
            large.join(lowest, large["a"] == lowest["node"])
            .where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(lowest.select(F.col("node").alias("a"), F.col("m").alias("b")))
            .distinct()
        )
        edges = small_store.store(small)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(edges.select(F.col("b"), F.col("b")).distinct())
