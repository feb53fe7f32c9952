"""Secret scans with a random forest that removes false positives.

Candidates are all runs of 12 or more key-like characters in whole texts, except
those of small letters alone, and all values of any length and any marks that are
assigned to a telling name or quoted after one. A candidate's features are its length, the shares of its
character classes, its entropy, how often the class changes, how likely its
letter transitions are in the corpus's words, how much of it dictionary words
cover, its path (the row's source) and its neighbouring words, hashed.

The dictionary is the ``DICTIONARY_WORDS`` words with the highest document
frequency, counted over all documents; the letter transitions are those of its
words, weighted. The forest is trained on a bounded, documented sample of
labelled findings (``LABELLED_FINDINGS``, those with the smallest hash). Where no
findings are labelled by hand, ``rule_labels`` labels them by known formats.

Defined cases: a null or empty text has no candidates; null sources are a path of
their own; a run within a longer assigned value is a finding besides that value;
rows that repeat a doc_id give their findings each; where all labels
agree or there are none, the probability is the labels' smoothed mean; an empty
table gives an empty result; other columns are not carried. Values are shown by
their first and last two characters (one below 12, none below 6) and a hash, never whole.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import id_held_out, sampled, table, written

DICTIONARY_WORDS = 5_000
LABELLED_FINDINGS = 20_000
FLUSH_WORDS = 200_000
TREES, DEPTH, SEED = 30, 8, 7
THRESHOLD = 0.5
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_\-]{12,}={0,2}")
_WORD = re.compile(r"[^\W\d_]{3,12}")
_NEAR = re.compile(r"\w+")
_PATHS, _BEFORE, _AFTER = 8, 16, 8
_NEAR_CHARS = 40
# Formats of known secrets, and names that a secret is assigned to.
_KNOWN = re.compile(r"(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abp]-[A-Za-z0-9-]{10,})")
_NAME = r"""(?:pass(?:word|wd)?|token|secret|api[_-]?key)["']?\s*"""
_ASSIGNED = re.compile(rf"""(?i){_NAME}[:=]\s*["']?$""")
# a quoted value after a name, or one up to the next space after a name and a sign
_VALUE = re.compile(
    rf"""(?i){_NAME}(?:(?:[:=]\s*)?(?:"([^"\n]+)"|'([^'\n]+)')|[:=]\s*["']?([^\s"']*[^\s"',;.)\]}}]))"""
)

_FINDING = (
    "doc_id long, start long, length int, preview string, sha256 string, rule_label int, features array<double>"
)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flushed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"],
        )

    for batch in batches:
        for text in batch.column(0):
            counts.update(set(_WORD.findall((text.as_py() or "").lower())))
            if len(counts) > FLUSH_WORDS:
                yield flushed()
                counts.clear()
    yield flushed()


def dictionary(docs: DataFrame, words: int = DICTIONARY_WORDS) -> dict[str, int]:
    """The words in most documents, with how many these are."""
    counted = docs.select("text").mapInArrow(_count_words, "word string, n long")
    top = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(words)
    return {r["word"]: r["n"] for r in top.collect()}


class Features:
    """Feature vector of a candidate in its text."""

    def __init__(self, words: dict[str, int]):
        self.words = frozenset(words)
        pairs: Counter = Counter()
        for word, n in words.items():
            for a, b in zip(f" {word}", f"{word} "):
                pairs[a + b] += n
        firsts: Counter = Counter()
        for pair, n in pairs.items():
            firsts[pair[0]] += n
        self.pairs = {p: math.log((n + 1) / (firsts[p[0]] + 40)) for p, n in pairs.items()}
        self.unseen = math.log(1 / (max(firsts.values(), default=0) + 40))

    def coverage(self, lower: str) -> float:
        """Share of the characters in dictionary words, longest first from the left."""
        covered = at = 0
        while at < len(lower):
            for size in range(min(12, len(lower) - at), 2, -1):
                if lower[at : at + size] in self.words:
                    covered += size
                    at += size
                    break
            else:
                at += 1
        return covered / len(lower)

    def vector(self, value: str, before: str, after: str, path: str) -> list[float]:
        size = len(value)
        kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in value]
        share = Counter(kinds)
        lower = value.lower()
        pairs = [self.pairs.get(a + b, self.unseen) for a, b in zip(lower, lower[1:])]
        places = [0.0] * (_PATHS + _BEFORE + _AFTER)
        places[zlib.crc32(path.encode("utf-8", "surrogatepass")) % _PATHS] = 1.0
        for word in _NEAR.findall(before.lower())[-2:]:
            places[_PATHS + zlib.crc32(word.encode("utf-8", "surrogatepass")) % _BEFORE] = 1.0
        for word in _NEAR.findall(after.lower())[:1]:
            places[_PATHS + _BEFORE + zlib.crc32(word.encode("utf-8", "surrogatepass")) % _AFTER] = 1.0
        return [
            float(size),
            share["d"] / size,
            share["u"] / size,
            share["l"] / size,
            -sum(n / size * math.log2(n / size) for n in Counter(value).values()),
            sum(a != b for a, b in zip(kinds, kinds[1:])) / size,
            sum(pairs) / max(1, len(pairs)),
            self.coverage(lower),
            *places,
        ]


def rule_label(value: str, before: str) -> int:
    """1 for a known format or an assignment to a telling name, else 0."""
    return int(bool(_KNOWN.fullmatch(value) or _ASSIGNED.search(before)))


def candidates(text: str) -> list[tuple[int, int]]:
    """Places of all candidates, in their order."""
    runs = (m for m in _CANDIDATE.finditer(text) if not (m.group().isalpha() and m.group().islower()))
    places = {m.span() for m in runs}
    places.update(m.span(m.lastindex) for m in _VALUE.finditer(text))
    return sorted(places)


def preview(value: str) -> str:
    """The first and last characters: two, one of short values, none of very short ones."""
    shown = 2 if len(value) >= 12 else 1 if len(value) >= 6 else 0
    return f"{value[:shown]}...{value[len(value) - shown:]}"


def findings(docs: DataFrame, words: dict[str, int]) -> DataFrame:
    """All candidates of all texts with their features and rule label."""
    shared = docs.sparkSession.sparkContext.broadcast(Features(words))  # DICTIONARY_WORDS words
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source"))
    fields = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.list_(pa.float64())]
    names = [f.split()[0] for f in _FINDING.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text, path in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                text = text.as_py() or ""
                for start, end in candidates(text):
                    value = text[start:end]
                    before, after = text[max(0, start - _NEAR_CHARS) : start], text[end : end + _NEAR_CHARS]
                    out.append((
                        doc_id, start, end - start, preview(value),
                        hashlib.sha256(value.encode()).hexdigest(), rule_label(value, before),
                        own.vector(value, before, after, path or ""),
                    ))
            columns = zip(*out) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, fields)], names=names)

    return rows.mapInArrow(run, _FINDING)


def classified(
    found: DataFrame, labelled: DataFrame, rows: int = LABELLED_FINDINGS, threshold: float = THRESHOLD
) -> DataFrame:
    """``found`` with probability and predicted, by a forest trained on ``labelled``.

    ``labelled`` has the columns features and label; at most ``rows`` are used.
    """
    sample = written(
        sampled(labelled.where("label IS NOT NULL"), rows, "features", "label")
        .select(array_to_vector("features").alias("vector"), F.col("label").cast("double").alias("label")),
        "findings-sample",
    )
    counts = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        share = (counts.get(1.0, 0) + 0.5) / (sum(counts.values()) + 1)
        scored = found.withColumn("probability", F.lit(share))
    else:
        forest = RandomForestClassifier(
            featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
            probabilityCol="votes", rawPredictionCol="raw", predictionCol="likelier",
        ).fit(sample)
        scored = (
            forest.transform(found.withColumn("vector", array_to_vector("features")))
            .withColumn("probability", vector_to_array("votes")[1])
            .drop("vector", "votes", "raw", "likelier")
        )
    return scored.withColumn("predicted", (F.col("probability") >= threshold).cast("int"))


def op9_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with the forest's verdict.

    The tables hold no labelled findings, so those of documents that are not held
    out are labelled by rule; the forest never sees the rule's own test.
    """
    docs = table(spark, sf_dir, "documents")
    found = written(findings(docs, dictionary(docs)), "findings")
    held_out = id_held_out(F.col("doc_id"))
    labelled = found.where(~held_out).select("features", F.col("rule_label").alias("label"))
    return classified(found, labelled).select(
        "doc_id", "start", "length", "preview", "sha256", "rule_label", held_out.alias("held_out"),
        "probability", "predicted",
    )
