"""Exact top-k search by inner product with MaxScore.

A vector's components are the terms of a document, its value at a component the
term's weight. Candidates are dealt into shards and queries into blocks; a task
holds one shard and one block. In a task, every component has a score bound for a
query: the most that any of the shard's candidates can gain there over the least.
A query's terms are sorted by bound. The weakest ones whose bounds together with
the least score stay below the k-th best score so far are non-essential: a
candidate cannot enter by them alone. The essential terms' postings are
traversed for all candidates; those whose score so far plus the bounds of the
other terms still competes are probed term by term, strongest first, and dropped
as soon as they do not. The shards' best k are merged.

The k-th best score to start with is that of a first few candidates scored in
full, so it is reached by real candidates and pruning below it loses nothing
(candidates that tie with it stay).

Defined cases: vectors that are null, of another length than the query, or hold
null or non-finite components take no part, and neither do null ids; rows that
repeat an id and vector count once; a candidate with the query's own id is the
query's own row; a query with fewer than k candidates gets all of them; a score beyond 64 bits
is the nearest long; empty tables give empty results; other columns are not carried.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm.common import table, written

SHARD_ROWS = 8_192
BLOCK_QUERIES = 2_048
FIRST_SCORED = 64
_LONG = 2**63 - 1
_BEST = "query_id long, vec_id long, score long"


def _exact(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether inner products of the integer matrices are exact in doubles."""
    if not a.size or not b.size:
        return True
    return float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


def search_shard(
    ids: np.ndarray, vectors: np.ndarray, query_id: int, query: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the shard's best k for one query; ``vectors`` is one row per term."""
    low = np.minimum(query * vectors.min(axis=1), query * vectors.max(axis=1))
    high = np.maximum(query * vectors.min(axis=1), query * vectors.max(axis=1))
    bound = high - low
    order = np.argsort(-bound, kind="stable")
    gained = bound[order][::-1].cumsum()[::-1]  # of each term and all weaker ones
    rest = np.append(low[order][::-1].cumsum()[::-1], 0)
    least = low.sum()

    first = query @ vectors[:, :FIRST_SCORED]
    others = ids[:FIRST_SCORED] != query_id
    started = np.sort(first[others])[::-1]
    threshold = started[k - 1] if len(started) >= k else -math.inf

    # non-essential: weaker terms that even together stay below the threshold
    essential = int((gained + least >= threshold).sum())
    strong = order[:essential]
    score = query[strong] @ vectors[strong] if essential else np.zeros(len(ids), query.dtype)
    weak = order[essential:]
    room = np.append(gained[essential:], 0)
    alive = np.flatnonzero((score + rest[essential] + room[0] >= threshold) & (ids != query_id))
    score = score[alive]
    for step, term in enumerate(weak):
        score = score + query[term] * vectors[term, alive]
        competes = score + rest[essential + step + 1] + room[step + 1] >= threshold
        if not competes.all():
            alive, score = alive[competes], score[competes]
        if len(score) > 4 * k:  # the threshold rises with what the rest can lose at most
            sure = np.partition(score, len(score) - k)[len(score) - k] + rest[essential + step + 1]
            threshold = max(threshold, sure)
    top = _best(ids[alive], score, k)
    return ids[alive][top], score[top]


def search_block(
    candidates: tuple[np.ndarray, np.ndarray], queries: tuple[np.ndarray, np.ndarray], k: int
) -> pd.DataFrame:
    """Best k of a shard for each query of a block."""
    ids, vectors = candidates
    exact = np.float64 if _exact(vectors, queries[1]) else object
    terms = np.ascontiguousarray(vectors.T.astype(exact))
    out: list[tuple[int, int, int]] = []
    for query_id, query in zip(queries[0].tolist(), queries[1].astype(exact)):
        found, scores = search_shard(ids, terms, query_id, query, k)
        out += [(query_id, int(i), max(-_LONG, min(_LONG, int(s)))) for i, s in zip(found, scores)]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def top_k(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Best ``k`` candidates of each query; both tables are (vec_id, vector array<long>)."""
    n = candidates.count()
    shards = max(1, -(-n // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // BLOCK_QUERIES))

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    dealt = candidates.select(
        "vec_id", "vector", F.size("vector").alias("terms"),
        F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).alias("shard"),
        all_of(blocks).alias("block"),
    )
    asked = queries.select(
        "vec_id", "vector", F.size("vector").alias("terms"),
        F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).alias("block"),
        all_of(shards).alias("shard"),
    )
    together = ["shard", "block", "terms"]

    def search(own: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if own.empty or ask.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        parts = [(f["vec_id"].to_numpy(), np.stack(f["vector"].to_numpy())) for f in (own, ask)]
        return search_block(*parts, k)

    found = (
        dealt.groupBy(*together).cogroup(asked.groupBy(*together)).applyInPandas(search, _BEST)
    )
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def quantised(embeddings: DataFrame, levels: int = 256) -> DataFrame:
    """(vec_id, vector) with floor(levels * x) of each component; unusable vectors left out."""
    component = F.col("embedding")
    usable = F.forall(
        component, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    return (
        embeddings.where(F.col("vec_id").isNotNull() & component.isNotNull()).where(usable)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.transform(component, lambda x: F.floor(x.cast("double") * levels)).alias("vector"),
        )
        .dropDuplicates(["vec_id", "vector"])
    )


def op4_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all other vectors for every fiftieth vector."""
    vectors = written(quantised(table(spark, sf_dir, "embeddings")), "vectors")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


OP4_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(generate_series(1, len(a.q)), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0
),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
