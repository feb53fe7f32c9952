import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barlake.llm import simple8b, token_files
from barlake.llm.common import written
from barlake.llm.tokens import encoder


def library_ids(vocabulary, text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary).encode(text or "", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 70_000), st.integers(0, 1), st.integers(0, 2**64 - 1)), max_size=600))
def test_simple8b_round_trip(values):
    ids = np.array(values, dtype=np.uint64)
    assert simple8b.decode(simple8b.encode(ids), len(ids)).tolist() == values


@pytest.mark.parametrize("selector", [k for k in range(16) if k != simple8b.ESCAPE])
def test_each_selector_packs_its_count(selector):
    count, bits = simple8b.LAYOUT[selector]
    words = simple8b.encode(np.full(count * 3, (1 << bits) - 1, dtype=np.uint64))
    assert len(words) == 3 and set((words >> np.uint64(60)).tolist()) == {selector}


def test_escape_holds_what_no_field_can():
    ids = np.array([5, 2**60, 7, 2**64 - 1, 2**60 | simple8b.ESCAPE << 60, 1], dtype=np.uint64)
    assert simple8b.decode(simple8b.encode(ids), 6).tolist() == ids.tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab'sé 1.,!?_\n\t\r\x00 　\x1f漢-<|>"), max_size=40))
def test_chunked_ids_equal_the_library(vocabulary_path, text):
    ids = np.frombuffer(encoder(vocabulary_path).ids(text), "<u4").tolist()
    assert ids == [*library_ids(vocabulary_path, text), 0]


@pytest.fixture(scope="module")
def vocabulary_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_known_traps(vocabulary):
    for text in ("", " ", "a  b", "a   b\n\n c", "x<|endoftext|> y <|endoftext|>", "it's, don't. 12.", " a", "a \nb",
                 "wait... what?! (no), \"q\".", "é, x", "½, ²."):
        ids = np.frombuffer(encoder(vocabulary).ids(text), "<u4").tolist()
        assert ids == [*library_ids(vocabulary, text), 0], text


def test_cache_overflow_keeps_results(vocabulary):
    from barlake.llm import tokens

    own = tokens.Encoder(vocabulary, cached_chunks=10)
    for k in range(30):
        text = f"word{k} alpha beta, gamma{k}. delta"
        assert np.frombuffer(own.ids(text), "<u4").tolist() == [*library_ids(vocabulary, text), 0]


def expected(vocabulary, rows):
    out, at = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library_ids(vocabulary, text), 0], dtype="<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def through_files(spark, docs, tmp_path, vocabulary, rows):
    token_files.write_token_files(docs(rows), str(tmp_path), vocabulary)
    got = token_files.token_documents(spark, str(tmp_path))
    return [tuple(r) for r in got.select("doc_id", "start", "n_tokens", "ids_crc32").collect()]


def test_file_set_round_trip(spark, docs, tmp_path, vocabulary, monkeypatch):
    rng = random.Random(2)
    rows = [(k * 3, " ".join(rng.choice(["the", "zu", "ön", "x1,", "."]) for _ in range(rng.randint(0, 300)))) for k in range(60)]
    rows += [(-5, None), (1000, ""), (1, "long text " * 30_000)]
    got = through_files(spark, docs, tmp_path / "f", vocabulary, rows)
    assert sorted(got) == sorted(expected(vocabulary, rows))
    blocks = spark.read.parquet(str(tmp_path / "f")).collect()
    for b in blocks:  # whole documents; each group of ids decodes alone
        assert sum(b["lengths"]) == b["n_ids"] and len(b["offsets"]) == -(-b["n_ids"] // token_files.GROUP_IDS)
    firsts = [b["doc_ids"][0] for b in sorted(blocks, key=lambda b: (b["shard"], b["block"]))]
    assert firsts == sorted(firsts)


def test_file_set_of_repeated_and_missing_rows(spark, docs, tmp_path, vocabulary):
    rows = [(4, "b"), (4, "b"), (4, "a a"), (None, "x"), (None, None)]
    got = through_files(spark, docs, tmp_path / "f", vocabulary, rows)
    ends = sorted((start, start + n) for _, start, n, _ in got)
    assert [e for _, e in ends[:-1]] == [s for s, _ in ends[1:]] and ends[0][0] == 0
    assert sorted((str(i), n, c) for i, _, n, c in got) == sorted((str(i), n, c) for i, _, n, c in expected(vocabulary, rows))
    assert through_files(spark, docs, tmp_path / "e", vocabulary, []) == []


def test_written_table_has_the_same_rows(spark):
    df = spark.createDataFrame([(1, None), (None, "a")], "a int, b string")
    assert sorted(map(str, written(df, "t").collect())) == sorted(map(str, df.collect()))


def test_samples_are_bounded_and_repeatable(spark):
    from barlake.llm.common import sampled

    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    first = [r["doc_id"] for r in sampled(df, 500, "doc_id").collect()]
    again = [r["doc_id"] for r in sampled(df.repartition(7), 500, "doc_id").collect()]
    assert len(first) == 500 and first == again
    assert sampled(df.limit(3), 500, "doc_id").count() == 3 and sampled(df.limit(0), 5, "doc_id").count() == 0


def test_equal_rows_are_split_over_shards(spark, docs, vocabulary, tmp_path):
    """A third of the rows equal in id and text: no part file holds them all."""
    rows = [(None, "same words")] * 600 + [(k, f"other {k}") for k in range(1200)]
    path = str(tmp_path / "tokens")
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")  # the table is small: keep its range partitions apart
    try:
        token_files.write_token_files(docs(rows).repartition(6), path, vocabulary)
    finally:
        spark.conf.set(merging, "true")
    sizes = [
        sum(d is None for d in r["ids"])
        for r in token_files.read_token_blocks(spark, path).selectExpr("doc_ids AS ids").collect()
    ]
    assert sum(sizes) == 600 and max(sizes) < 600
    got = token_files.token_documents(spark, path).orderBy("start").collect()
    assert len(got) == 1800 and [r["start"] for r in got][:2] == [0, got[0]["n_tokens"]]
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(got, got[1:]))
