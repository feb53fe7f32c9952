import collections
import random

import pytest

import corpus_pipeline
from barlake.llm import decontam, line_dedup, simhash, toxicity
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_packing import check_pieces
from tests.llm.test_simhash import brute_classes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table_rows():
    rng = random.Random(6)
    plain = [f"word{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]
    passage = " ".join(f"passage{rng.randint(0, 10**6)}" for _ in range(60))
    item = " ".join(f"item{k}" for k in range(20))
    rows, labels = [], []
    for k in range(150):
        lines = [" ".join(rng.choice(plain) for _ in range(20)) for _ in range(4)]
        if k % 7 == 0:
            lines[1] += " grobnak grobnak snivelung"
        if k % 5 == 0:
            lines.insert(2, passage)
        if k % 11 == 0:
            lines[0] = item
        rows.append((k, "\n".join(lines)))
        labels.append((k, 1, int(k % 7 == 0)))
    rows += [(1000 + k, rows[1][1]) for k in range(5)] + [(2000, None), (2001, ""), (2002, None)]
    return rows, labels, [(1, item)]


@pytest.fixture
def sf_dir(spark, tmp_path):
    rows, labels, items = table_rows()
    tables = {
        "documents": ([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS),
        "labels": (labels, "doc_id long, quality int, toxic int"),
        "benchmark": (items, "item_id long, text string"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_every_stage_equals_brute_force_on_its_input(spark, sf_dir, tmp_path, vocabulary):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / f"stage{k}"))
        after = spark.read.parquet(str(tmp_path / f"stage{k}"))
        if name != "packing":
            assert after.schema.names == docs.schema.names
            rows = [(r["doc_id"], r["text"]) for r in after.collect()]
            assert all(r["n_chars"] == len(r["text"] or "") or r["text"] is None for r in after.collect())
        if name == "toxicity":
            assert {i for i, _ in before} - {i for i, _ in rows} == {i for i in range(150) if i % 7 == 0}
        elif name == "line dedup":
            assert collections.Counter(rows) == collections.Counter(brute_lines(before, line_dedup.MIN_WORDS))
        elif name == "near duplicates":
            _, low = brute_classes(before)
            assert sorted(i for i, _ in rows) == sorted(set(low))
        elif name == "decontamination":
            item = decontam.words_of(table_rows()[2][0][1])
            assert {i for i, _ in before} - {i for i, _ in rows} == {
                i for i, t in before if b" ".join(item[:13]) in b" ".join(decontam.words_of(t))
            }
        else:
            check_pieces(after.collect(), before, vocabulary, 2048)
        docs = after


def test_run_applies_the_stages(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(got[0].asDict())
    assert not any(r["doc_id"] % 7 == 0 for r in got if r["doc_id"] < 150)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "near duplicates", "decontamination", "packing",
    ]


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.collect() == []


def test_constants_follow_the_contract():
    assert (simhash.SHINGLE, simhash.MAX_BITS, toxicity.THRESHOLD, decontam.WINDOW) == (3, 2, 0.3, 13)
