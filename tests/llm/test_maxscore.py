import math

import numpy as np
import pytest

from barlake.llm import maxscore
from barlake.llm.common import ship_package


def brute(rows, k, every):
    usable = {}
    for vec_id, vector in rows:
        if vec_id is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            usable[(vec_id, tuple(math.floor(256 * float(np.float32(x))) for x in vector))] = None
    out = []
    for query_id, q in usable:
        if query_id % every:
            continue
        scores = sorted(
            (-sum(a * b for a, b in zip(q, v)), i) for i, v in usable if i != query_id and len(v) == len(q)
        )
        out += [(query_id, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, k, every):
    ship_package(spark)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = maxscore.quantised(df)
    return sorted(tuple(r) for r in maxscore.top_k(vectors, vectors.where(f"vec_id % {every} = 0"), k).collect())


@pytest.mark.parametrize("kind", ["dense", "sparse", "ties"])
def test_equals_all_inner_products(spark, monkeypatch, kind):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 60)
    monkeypatch.setattr(maxscore, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(2)
    m = rng.normal(0, 0.15, (400, 16))
    if kind == "sparse":
        m *= rng.random((400, 16)) < 0.2
    if kind == "ties":
        m = np.round(m * 4) / 4
        m[50:150] = m[50]
    rows = [(int(k), [float(x) for x in v]) for k, v in enumerate(m)]
    assert run(spark, rows, 5, 10) == brute(rows, 5, 10)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -1.0]), (2, [0.5, 0.25]), (4, None), (6, [None, 1.0]), (8, [nan, 1.0]), (10, [inf, 0.0]),
            (12, [1.0]), (None, [1.0, 1.0]), (2, [0.5, 0.25]), (14, []), (16, [-3.0, 2.0])]
    assert run(spark, rows, 5, 2) == brute(rows, 5, 2)
    assert run(spark, [], 5, 2) == []
    assert run(spark, [(1, [1.0])], 5, 2) == []


def test_pruning_probes_only_what_competes():
    """A strong term decides; the weak terms are looked at for few candidates."""
    rng = np.random.default_rng(0)
    vectors = np.vstack([rng.integers(0, 1000, 5000), rng.integers(0, 3, (20, 5000))]).astype(float)
    ids = np.arange(5000)
    query = np.ones(21)
    found, scores = maxscore.search_shard(ids, vectors, -1, query, 5)
    full = query @ vectors
    order = np.lexsort((ids, -full))[:5]
    assert found.tolist() == order.tolist() and scores.tolist() == full[order].tolist()


def test_wide_integers_stay_exact():
    ids = np.array([1, 2])
    big = 2**40
    out = maxscore.search_block((ids, np.array([[big, 1], [big, 0]])), (np.array([3]), np.array([[big, 1]])), 2)
    assert out["score"].tolist() == [big * big + 1 if big * big + 1 < 2**63 else 2**63 - 1] * 1 + [min(big * big, 2**63 - 1)]
