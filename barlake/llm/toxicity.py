"""Toxicity scores from a learned lexicon, matched by Levenshtein automata on a trie.

Training takes a bounded, documented sample of labelled rows (``LABELLED_ROWS``,
those with the smallest hash of their id; all counts below are over that sample):

1. words and word beginnings (stems) are counted per label by a grouped
   aggregation that leaves quoted and reported occurrences out, and those that mark toxic rows beyond chance once more by the
   different surroundings they occur in, so that copies of a text count once; what
   still stands out is the lexicon, where a stem stands for its words when no
   single word explains it;
2. every word of a text is run against the lexicon's trie with the Levenshtein
   automaton of the word: the automaton's states (one row of edit distances) move
   along the trie's edges, and a branch dies when all states exceed the budget of
   its terms (none below 5 letters, 1 up to 7, 2 beyond);
3. a window around each match decides between abuse and quotation: quotation
   marks open around it, or a reporting word just before it;
4. a logistic regression on the counts of exact, stem, misspelled and quoted
   matches and their density gives the score.

Defined cases: a null or empty text has no words and gets the score of a text
without matches; labels with a null id or value are not used, and an id labelled
more than once is toxic if any label says so; rows that repeat a doc_id are each
scored; where no lexicon can be learned (no usable label, labels of one kind, no
term that stands out) all scores are nearly 0 and no document is toxic; an empty table gives an empty result; other columns stay, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import appended, extended, fresh, id_held_out, sampled, table, written

LABELLED_ROWS = 20_000
CANDIDATE_TERMS = 20_000
LEXICON_SIZE = 500
THRESHOLD = 0.3
STEM_LENGTHS = range(4, 9)
CACHED_WORDS = 100_000
CONTEXT_WORDS = 4
_WORD = re.compile(r"[^\W_]+")
# Marks that open and close a quotation, and words that report one.
_QUOTES = (("“", "”"), ("«", "»"), ("„", "“"), ("‹", "›"))
_MARK = re.compile('["\\n' + "".join({mark for pair in _QUOTES for mark in pair}) + "]")
_REPORTING = frozenset(
    "said says called wrote quote quoted quotes term word slur dit disait écrit mot "
    "dijo llamó escribió palabra sagte nannte schrieb wort zitat".split()
)


def _budget(term: str, stem: bool) -> int:
    """Edits allowed for a term."""
    size = len(term)
    if stem:
        return 0 if size < 8 else 1
    return 0 if size < 5 else 1 if size < 8 else 2


@dataclass
class Lexicon:
    """Terms in a trie; an entry is (term, is it a stem)."""

    entries: list[tuple[str, bool]]

    def __post_init__(self) -> None:
        self.trie: dict = {}
        # parts of terms that are free of edits, by where they are looked for
        self.starts: dict[int, set[str]] = {}
        self.ends: dict[int, set[str]] = {}
        self.middles: dict[tuple[int, int], set[str]] = {}
        for term, stem in self.entries:
            budget = _budget(term, stem)
            node = self.trie
            for letter in term:
                node["budget"] = max(node.get("budget", 0), budget)
                node = node.setdefault(letter, {})
            node["budget"] = max(node.get("budget", 0), budget)
            node["stem" if stem else "word"] = budget
            # of budget + 1 parts of a term at least one is free of edits
            cuts = [len(term) * k // (budget + 1) for k in range(budget + 2)]
            self.starts.setdefault(cuts[1], set()).add(term[: cuts[1]])
            for k in range(1, budget + 1):
                part = term[cuts[k] : cuts[k + 1]]
                if k == budget and not stem:
                    self.ends.setdefault(len(part), set()).add(part)
                else:  # edits before it may have moved it
                    for shift in range(-budget, budget + 1):
                        at = cuts[k] + shift
                        self.middles.setdefault((at, at + len(part)), set()).add(part)

    def may_match(self, word: str) -> bool:
        """Whether some term's part that is free of edits is at its place in the word."""
        return (
            any(word[:n] in parts for n, parts in self.starts.items())
            or any(word[-n:] in parts for n, parts in self.ends.items())
            or any(word[a:b] in parts for (a, b), parts in self.middles.items())
        )

    def match(self, word: str) -> str:
        """'exact', 'stem' or 'fuzzy' for the best match, or ''."""
        if not self.entries or not self.may_match(word):
            return ""
        best = ""
        stack = [(self.trie, list(range(len(word) + 1)))]
        while stack:
            node, row = stack.pop()
            if row[-1] <= node.get("word", -1):
                if row[-1] == 0:
                    return "exact"
                best = best or "fuzzy"
            if "stem" in node and min(row) <= node["stem"]:
                best = "stem" if min(row) == 0 else best or "fuzzy"
            for letter, child in node.items():
                if len(letter) > 1:  # an attribute, not an edge
                    continue
                moved = [row[0] + 1]
                for j, own in enumerate(word):
                    moved.append(min(row[j] + (own != letter), row[j + 1] + 1, moved[j] + 1))
                if min(moved) <= child["budget"]:
                    stack.append((child, moved))
        return best


def _mentions(lower: str) -> tuple[list[str], list[bool]]:
    """All words of a text, and which of them marks around them or a reporting word
    before them show to be quoted.

    One pass over the marks: between two of them, all places are quoted or none is.
    """
    last: dict[str, int] = {}
    final: dict[tuple[int, str], int] = {}
    marks = [(m.start(), m.group()) for m in _MARK.finditer(lower)]
    line = 0
    lines = []
    for at, mark in marks:
        lines.append(line)
        if mark == "\n":
            line += 1
        else:
            final[line, mark] = at
    words: list[str] = []
    quoted: list[bool] = []
    k = odd = line = 0
    inside, reported = False, -CONTEXT_WORDS - 1
    for n, place in enumerate(_WORD.finditer(lower)):
        moved = False
        while k < len(marks) and marks[k][0] < place.start():
            at, mark = marks[k]
            line, moved, k = lines[k], True, k + 1
            if mark == "\n":
                last.clear()
                line, odd = line + 1, 0
            else:
                last[mark] = at
                odd ^= mark == '"'
        if moved:
            after = marks[k - 1][0]
            inside = bool(odd and final[line, '"'] > after) or any(
                last.get(a, -1) > last.get(b, -1) and final.get((line, b), -1) > after for a, b in _QUOTES
            )
        word = place.group()
        words.append(word)
        quoted.append(inside or n - reported <= CONTEXT_WORDS)
        if word in _REPORTING:
            reported = n
    return words, quoted


@dataclass
class Model:
    lexicon: Lexicon
    weights: list[float] = field(default_factory=list)  # the last one is the intercept

    def features(self, text: str | None, known: dict[str, str]) -> list[float]:
        """Match counts of a text; ``known`` keeps words that have been looked up."""
        lower = (text or "").lower()
        words = _WORD.findall(lower)
        kinds = list(map(known.get, words))
        if None in kinds:
            if len(known) > CACHED_WORDS:
                known.clear()
            match = self.lexicon.match
            for k, kind in enumerate(kinds):
                if kind is None:
                    word = words[k]
                    kinds[k] = known[word] = known[word] if word in known else match(word)
        count = Counter(kinds)
        if count[""] == len(words):
            return [0.0] * 6
        quoted = Counter(kind for kind, mark in zip(kinds, _mentions(lower)[1]) if kind and mark)
        count.subtract(quoted)
        direct = count["exact"] + count["stem"] + count["fuzzy"]
        return [
            math.log1p(count["exact"]),
            math.log1p(count["stem"]),
            math.log1p(count["fuzzy"]),
            math.log1p(sum(quoted.values())),
            float(count["exact"] + count["stem"] > 0),
            math.log1p(100 * direct / (len(words) + 10)),
        ]

    def score(self, features: list[float]) -> float:
        z = self.weights[-1] + sum(w * x for w, x in zip(self.weights, features))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, doc_id: str, text: str) -> DataFrame:
    """(text, toxic) of the sampled labelled rows, none of them held out."""
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("labelled_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("labelled_id IS NOT NULL AND toxic IS NOT NULL")
        .where(~id_held_out(F.col("labelled_id")))
        .groupBy("labelled_id").agg(F.max("toxic").alias("toxic"))
    )
    chosen = sampled(usable, rows, "labelled_id")
    texts = docs.select(F.col(doc_id).cast("long").alias("own_id"), F.col(text).alias("text"))
    joined = texts.join(F.broadcast(chosen), texts["own_id"] == chosen["labelled_id"])  # `rows` ids
    return written(joined.select("text", (F.col("toxic") > 0).cast("int").alias("toxic")), "labelled")


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
            spoken = zip(*_mentions((text.as_py() or "").lower()))
            words = {w for w, quoted in spoken if not quoted and 3 <= len(w) <= 40}
            stems = {w[:n] + "*" for w in words for n in STEM_LENGTHS if len(w) > n}
            counts[toxic].update(words)
            counts[toxic].update(stems)
    terms = list(counts[0].keys() | counts[1].keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()),
         pa.array([counts[0][t] for t in terms], pa.int64())],
        names=["term", "toxic", "clean"],
    )


def _count_surroundings(terms: frozenset[str]):
    """(term, toxic, hash of the words before and after) of each occurrence of ``terms``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: set[tuple[str, int, int]] = set()
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                spoken, mentions = _mentions((text.as_py() or "").lower())
                words = ["", *spoken, ""]
                for before, word, after, quoted in zip(words, words[1:], words[2:], mentions):
                    if quoted:
                        continue
                    place = zlib.crc32(f"{before} {after}".encode("utf-8", "surrogatepass"))
                    if word in terms:
                        rows.add((word, toxic, place))
                    for n in STEM_LENGTHS:
                        if len(word) > n and word[:n] + "*" in terms:
                            rows.add((word[:n] + "*", toxic, place))
            columns = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(columns, (pa.string(), pa.int32(), pa.int64()))],
                names=["term", "toxic", "place"],
            )

    return run


def _surprise(toxic: Column, clean: Column, share: float) -> Column:
    """Log-likelihood ratio of a term's rows against the share of toxic rows."""
    both = toxic + clean
    return 2 * (
        toxic * F.log(toxic / (both * share))
        + F.when(clean > 0, clean * F.log(clean / (both * (1 - share)))).otherwise(0.0)
    )


def learn_lexicon(sample: DataFrame, toxic_rows: int, rows: int) -> Lexicon:
    """Terms that mark toxic rows: nine in ten of their rows, far beyond chance."""
    if not toxic_rows or toxic_rows == rows:
        return Lexicon([])
    share = toxic_rows / rows
    toxic, clean = F.col("toxic"), F.col("clean")
    terms = written(
        sample.mapInArrow(_count_terms, "term string, toxic long, clean long")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where("toxic + clean >= 3"),
        "terms",
    )
    # chance alone leaves about one term in five runs above this
    least = 2 * math.log(5 * max(1, terms.count()))
    telling = (_surprise(toxic, clean, share) > least) & (toxic >= 0.9 * (toxic + clean))
    marked = (
        terms.where("toxic > 0").where(telling)
        .orderBy(_surprise(toxic, clean, share).desc(), "term").limit(CANDIDATE_TERMS).collect()
    )
    places = (
        sample.mapInArrow(
            _count_surroundings(frozenset(r["term"] for r in marked)), "term string, toxic int, place long"
        )
        .distinct().groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
    )
    found = (
        places.where("toxic > 0").where(telling)
        .orderBy(_surprise(toxic, clean, share).desc(), "term").limit(LEXICON_SIZE).collect()
    )
    kept: dict[str, int] = {}
    for row in sorted(found, key=lambda r: (not r["term"].endswith("*"), len(r["term"])), reverse=True):
        term, seen = row["term"], row["toxic"]
        if not term.endswith("*"):
            kept[term] = seen
            continue
        below = [t for t in kept if t.startswith(term[:-1])]
        if max((kept[t] for t in below), default=0) < 0.9 * seen:
            for t in below:
                del kept[t]
            kept[term] = seen
    return Lexicon([(t.rstrip("*"), t.endswith("*")) for t in sorted(kept)])


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Logistic regression by Newton steps; the intercept is not shrunk."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
        gradient = x.T @ (p - y) + penalty @ weights
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights.tolist()


def train(
    docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS, doc_id: str = "doc_id", text: str = "text"
) -> Model:
    """Lexicon and weights from at most ``rows`` labelled rows."""
    sample = labelled_sample(docs, labels, rows, doc_id, text)
    found = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, toxic = sum(found.values()), found.get(1, 0)
    model = Model(learn_lexicon(sample, toxic, total))
    if not model.lexicon.entries:  # nothing to tell documents apart by: none is toxic
        model.weights = [0.0] * 6 + [-50.0]
        return model

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        for batch in batches:
            rows = [model.features(t.as_py(), known) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"]
            )

    measured = sample.mapInArrow(measure, "x array<double>, toxic int").collect()  # `rows` rows
    model.weights = _fit(
        np.array([r["x"] for r in measured]), np.array([r["toxic"] for r in measured], dtype=float)
    )
    return model


def with_scores(docs: DataFrame, model: Model, column: str, text: str = "text") -> DataFrame:
    """``docs`` with the score of its whole text."""
    place = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most LEXICON_SIZE terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = shared.value, {}
        for batch in batches:
            scores = [own.score(own.features(t.as_py(), known)) for t in batch.column(place)]
            yield appended(batch, {column: pa.array(scores, pa.float64())})

    return docs.mapInArrow(run, extended(docs, f"`{column}` double"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold."""
    (score,) = fresh(docs, "score")
    scored = with_scores(docs, train(docs, labels), score)
    return scored.where(F.col(score) < threshold).select(*docs.columns)


def op1_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_scores(docs, train(docs, table(spark, sf_dir, "labels")), "score")
    return scored.select(
        "doc_id",
        id_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
