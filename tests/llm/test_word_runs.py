import hashlib
import random
import zlib

import pytest

from barlake.llm import word_runs


def brute(words):
    """(start, length, period) of all runs, every period tried."""
    n, out = len(words), []
    for q in range(1, n // word_runs.MIN_EXPONENT + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            smallest = not any(
                all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, q)
            )
            if length >= max(word_runs.MIN_WORDS, word_runs.MIN_EXPONENT * q) and smallest:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng):
    letters, n = rng.choice([1, 2, 3, 6]), rng.randint(0, 60)
    words = [rng.randint(0, letters) for _ in range(n)]
    if rng.random() < 0.6:
        block = [rng.randint(0, letters) for _ in range(rng.randint(1, 8))]
        words[rng.randint(0, n) : 0] = (block * rng.randint(2, 9))[: rng.randint(1, 50)]
        if rng.random() < 0.3:
            words *= rng.randint(1, 5)
    return words


def test_sequences_match_brute_force():
    rng = random.Random(12)
    for _ in range(1500):
        words = random_words(rng)
        assert word_runs.sequence_runs(words) == brute(words), words


def test_cutting_at_rare_words_loses_no_run():
    rng = random.Random(13)
    texts = [[str(x).encode() for x in random_words(rng)] for _ in range(600)]
    assert word_runs.text_runs(texts) == [brute(t) for t in texts]


def test_squares_have_roots_that_are_no_powers():
    rng = random.Random(14)
    for _ in range(200):
        ids = [rng.randint(0, 2) for _ in range(rng.randint(0, 30))]
        expect = {
            (i, p) for i in range(len(ids)) for p in range(1, (i + 1) // 2 + 1)
            if ids[i - p + 1 : i + 1] == ids[i - 2 * p + 1 : i - p + 1]
            and not any(p % r == 0 and ids[i - p + 1 : i + 1] == ids[i - r + 1 : i + 1] * (p // r) for r in range(1, p))
        }
        assert sorted(word_runs.squares(ids)) == sorted(expect)


def test_long_texts():
    block = list(range(30_000))
    assert word_runs.sequence_runs(block * 5) == [(0, 150_000, 30_000)]
    assert word_runs.text_runs([[b"a"] * 200_000]) == [[(0, 200_000, 1)]]
    assert word_runs.text_runs([[b"%d" % k for k in range(200_000)]]) == [[]]


def test_weaker_runs_are_refused():
    with pytest.raises(ValueError):
        word_runs.text_runs([[b"a"]], exponent=3)


def test_documents_with_odd_rows(docs):
    song = "la " * 7 + "end"
    rows = [(1, song), (1, song), (None, song), (2, None), (3, ""), (4, "\t \n"), (5, "a a " * 6), (6, "x\r\ny " * 5)]
    got = sorted(word_runs.with_runs(docs(rows)).collect(), key=str)
    found = {(r["doc_id"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in got}
    assert len(got) == len(rows)
    assert found == {
        (1, ((0, 7, 1),), "la end"), (None, ((0, 7, 1),), "la end"), (2, (), ""), (3, (), ""), (4, (), ""),
        (5, ((0, 6, 1),), "a a"), (6, ((0, 10, 2),), "x y"),
    }


def test_empty_table_and_clashing_names(spark, docs):
    assert word_runs.with_runs(docs([])).collect() == []
    df = spark.createDataFrame([(1, "a " * 6, 7, 8)], "doc_id long, text string, runs int, collapsed int")
    (row,) = word_runs.with_runs(df).collect()
    assert row["runs"] == 7 and row["collapsed"] == 8 and row["collapsed_"] == "a"


def planted(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query_on_a_table(spark, docs, tmp_path):
    rng = random.Random(15)
    rows = [(k, " ".join(map(str, random_words(rng)))) for k in range(400)] + [(7, None), (None, "b " * 9), (25, "")]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    expect = []
    for doc_id, text in rows:
        words = planted(doc_id, text)
        runs = brute(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        left = b" ".join(w for i, w in enumerate(words) if i not in dropped)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        expect.append((
            doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest(),
        ))
    got = [tuple(r) for r in word_runs.op12_query(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(expect, key=str)
    assert any(planted(d, t) != (t or "").encode().split() for d, t in rows)
