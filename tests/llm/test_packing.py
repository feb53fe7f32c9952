import collections
import random
import zlib

import numpy as np
import pytest

from barlake.llm import packing
from barlake.llm.tokens import encoder


def sequences_of(plan):
    bins, seen = collections.defaultdict(list), collections.Counter()
    for length, lo, hi, first, each, offset in plan.runs:
        for rank in range(lo, hi):
            bins[first + (rank - lo) // each].append((offset + (rank - lo) % each * length, length))
            seen[length] += 1
    return bins, seen


def check_gapless(bins, capacity):
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity


def optimum(items, capacity):
    items = sorted(items, reverse=True)
    best = len(items)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for room in set(bins):
            if room >= items[k]:
                rest = list(bins)
                rest.remove(room)
                go(k + 1, [*rest, room - items[k]])
        go(k + 1, [*bins, capacity - items[k]])

    go(0, [])
    return best


def test_reduction_keeps_the_optimum():
    rng, worse = random.Random(3), 0
    for _ in range(400):
        capacity = rng.randint(8, 40)
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 9))]
        counts = collections.Counter(items)
        best = optimum(items, capacity)
        plan = packing.Plan([counts[w] for w in range(capacity + 1)], capacity)
        packing.reduce_instance(plan)
        rest = [w for w in range(capacity + 1) for _ in range(plan.left[w])]
        assert plan.sequences + optimum(rest, capacity) == best, (items, capacity)
        whole = packing.plan_packing(counts, capacity)
        bins, seen = sequences_of(whole)
        assert seen == counts and len(bins) == whole.sequences
        check_gapless(bins, capacity)
        worse += whole.sequences > best
    assert worse <= 4


@pytest.mark.parametrize(
    "lengths, j, found",
    [
        ({60: 1, 40: 1, 30: 1}, 60, [60, 40]),  # fills the sequence
        ({90: 1, 40: 1}, 90, [90]),  # nothing fits
        ({60: 1, 39: 1, 30: 1}, 60, [60, 39]),  # one partner at most
        ({50: 1, 25: 1, 20: 1, 2: 1}, 50, None),  # three partners fit
    ],
)
def test_dominance_rules(lengths, j, found):
    assert packing.dominant_set([lengths.get(w, 0) for w in range(101)], 100, j) == found


def check_pieces(got, rows, vocabulary, capacity):
    bins, per = collections.defaultdict(list), collections.defaultdict(list)
    want = collections.Counter()
    for _, text in rows:
        ids = encoder(vocabulary).ids(text)
        n = len(ids) // 4
        cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b]))] += 1
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        per[(r["piece"], r["start"], r["length"], r["ids_crc32"])].append(r)
    assert {k: len(v) for k, v in per.items()} == dict(want)
    check_gapless(bins, capacity)
    return len(bins)


def test_documents_are_packed_whole(spark, docs, vocabulary):
    rng = random.Random(4)
    rows = [(k, " ".join("word" for _ in range(rng.choice([0, 1, 5, 40, 90, 200])))) for k in range(120)]
    rows += [(500, None), (501, "deep " * 20_000), (500, "again"), (None, "x"), (7, "same"), (7, "same")]
    got = packing.pack_documents(docs(rows), vocabulary, capacity=64).collect()
    used = check_pieces(got, rows, vocabulary, 64)
    total = sum(r["length"] for r in got)
    assert used <= -(-total // 64) + 1


def test_empty_table(spark, docs, vocabulary):
    assert packing.pack_documents(docs([]), vocabulary).collect() == []


def test_large_histogram_is_near_the_lower_bound():
    rng = np.random.default_rng(0)
    lengths = np.minimum(rng.lognormal(6, 1.2, 200_000).astype(int) + 1, 2048)
    plan = packing.plan_packing({int(w): int(n) for w, n in zip(*np.unique(lengths, return_counts=True))})
    assert plan.reduced and plan.sequences <= -(-int(lengths.sum()) // 2048) * 1.01 + 1
    assert len(plan.runs) < 20_000
