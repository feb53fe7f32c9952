"""Periodic runs of words: suffix automaton and link-cut access to last occurrences.

A run is a longest stretch of words with smallest period q (words q apart are equal)
that holds its period at least ``MIN_EXPONENT`` times and ``MIN_WORDS`` words.

The automaton of a word sequence has a state for each set of substrings that end at
the same places; its suffix links form a tree in which the path from a prefix's state
to the root holds all suffixes of the prefix. Appending word i accesses that path and
recolours it with i. A path is met as segments of one colour: the suffixes with lengths
in (low, high] last ended at e. If the distance i - e lies in (low, high], the last i - e
words repeat those before them: a square whose root is not a power, since a root that
were one would have ended later than e. Squares of one period that end at consecutive
places extend to one run. As in a link-cut tree an access merges the segments it passes;
they are kept as one stack per heavy path of the tree, which is known before the walk,
so an access costs a logarithmic number of segments, amortised, and no rotations.

Before the automaton is built, words that cannot be part of a run cut the sequence:
in a run each word occurs 4 times or more, and each place is covered by a sequence of
4 words that occurs 3 times or more. Both are counted for many texts at once and again
in the parts that remain. This drops no run; most texts end there.

Every text is one row of one task, and a worker holds about 100 bytes per word of its
longest text besides the words. Runs are exact: nothing is hashed.

Defined cases: null and empty texts have no words, no runs and the empty collapsed text;
texts of any length are taken whole; rows that repeat each other get the same result; an
empty table gives an empty result; other columns stay, whatever their names.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import appended, extended, fresh, table

MIN_WORDS = 6
MIN_EXPONENT = 4
GRAM = 4  # words; each place of a run is in one that occurs MIN_EXPONENT - 1 times
BATCH_BYTES = 2_000_000  # of texts counted at once
ROUNDS = 12  # of counting again; what is left then goes to the automaton
_RUNS = pa.list_(
    pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
)
_RUNS_DDL = "array<struct<start:bigint,length:bigint,period:bigint>>"


class SuffixAutomaton:
    """States of a sequence of ids; most have one transition, the others are in ``more``."""

    def __init__(self, ids: list[int]):
        self.link = link = array("i", [-1])
        self.length = length = array("i", [0])
        word, to = array("i", [-1]), array("i", [-1])
        more: dict[int, dict[int, int]] = {}
        self.prefix = prefix = array("i")
        last = 0
        for i, c in enumerate(ids):
            new = len(link)
            link.append(0)
            length.append(i + 1)
            word.append(-1)
            to.append(-1)
            p = last
            while p >= 0:
                if word[p] == c or (p in more and c in more[p]):
                    break
                if word[p] < 0:
                    word[p], to[p] = c, new
                else:
                    more.setdefault(p, {})[c] = new
                p = link[p]
            if p >= 0:
                q = to[p] if word[p] == c else more[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    clone = len(link)
                    link.append(link[q])
                    length.append(length[p] + 1)
                    word.append(word[q])
                    to.append(to[q])
                    if q in more:
                        more[clone] = dict(more[q])
                    while p >= 0:
                        if word[p] == c:
                            if to[p] != q:
                                break
                            to[p] = clone
                        elif p in more and more[p].get(c) == q:
                            more[p][c] = clone
                        else:
                            break
                        p = link[p]
                    link[q] = link[new] = clone
            last = new
            prefix.append(new)

    def heavy_heads(self) -> array:
        """Of every state the top of its heavy path in the tree of suffix links."""
        n = len(self.link)
        by_length = np.argsort(np.frombuffer(self.length, dtype="i4"), kind="stable").tolist()
        weight = array("i", [1]) * n
        heavy = array("i", [-1]) * n
        best = array("i", [0]) * n
        link = self.link
        for v in reversed(by_length):
            up = link[v]
            if up >= 0:
                weight[up] += weight[v]
                if weight[v] > best[up]:
                    best[up], heavy[up] = weight[v], v
        head = array("i", range(n))
        for v in by_length:
            if heavy[v] >= 0:
                head[heavy[v]] = head[v]
        return head


def squares(ids: list[int]) -> Iterator[tuple[int, int]]:
    """(end, period) of all squares with a root that is not a power, by end."""
    automaton = SuffixAutomaton(ids)
    link, length, head = automaton.link, automaton.length, automaton.heavy_heads()
    segments: dict[int, list[tuple[int, int]]] = {}  # of a heavy path, the shortest last
    for i, state in enumerate(automaton.prefix):
        while state > 0:
            top = head[state]
            reach = length[state]
            up = link[top]
            low = length[up] if up >= 0 else 0
            stack = segments.get(top)
            if stack is None:
                segments[top] = [(reach, i)]
            else:
                while stack:
                    high, end = stack[-1]
                    distance = i - end
                    if low < distance <= (high if high < reach else reach):
                        yield i, distance
                    if high > reach:
                        break
                    stack.pop()
                    low = high
                stack.append((reach, i))
            state = up


def sequence_runs(
    ids: list[int], min_words: int = MIN_WORDS, exponent: int = MIN_EXPONENT
) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence, by start, then period."""
    found, growing = [], {}

    def close(period: int, first: int, last: int) -> None:
        length = last - first + 2 * period
        if length >= max(min_words, exponent * period):
            found.append((first - 2 * period + 1, length, period))

    for end, period in squares(ids):
        grown = growing.get(period)
        if grown is not None and grown[1] == end - 1:
            grown[1] = end
        else:
            if grown is not None:
                close(period, *grown)
            growing[period] = [end, end]
    for period, grown in growing.items():
        close(period, *grown)
    return sorted(found, key=lambda run: (run[0], run[2]))


def _parts(place: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Number of the part each place is in: consecutive places of one text."""
    new = np.ones(len(place), dtype=bool)
    new[1:] = (place[1:] != place[:-1] + 1) | (text[1:] != text[:-1])
    return np.cumsum(new) - 1


def _often(keys: np.ndarray, times: int) -> np.ndarray:
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[which] >= times


def _codes(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def candidate_places(word: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places, in order, that may be in a run; ``word`` and ``text`` number all words."""
    place = np.arange(len(word))
    for _ in range(ROUNDS):
        before = len(place)
        if not before:
            break
        part = _parts(place, text[place])
        keep = _often(part * (int(word.max()) + 1) + word[place], MIN_EXPONENT)
        place = place[keep]
        part = _parts(place, text[place])
        place = place[(np.bincount(part) >= MIN_WORDS)[part]] if len(place) else place
        if len(place) < MIN_WORDS:
            return place[:0]
        # sequences of GRAM words within a part, by pairs of pairs
        part = _parts(place, text[place])
        code = _codes(word[place])
        for step in (1, 2):
            code = _codes(code[:-step] * (int(code.max()) + 1) + code[step:])
        whole = part[: 1 - GRAM] == part[GRAM - 1 :]
        kept = np.zeros(len(code), dtype=bool)
        keys = part[: 1 - GRAM] * (int(code.max()) + 1) + code
        kept[whole] = _often(keys[whole], MIN_EXPONENT - 1)
        covered = np.zeros(len(place), dtype=bool)
        for step in range(GRAM):
            covered[step : len(place) - GRAM + 1 + step] |= kept
        place = place[covered]
        if len(place) == before:
            break
    return place


def text_runs(
    texts: list[list[bytes]], min_words: int = MIN_WORDS, exponent: int = MIN_EXPONENT
) -> list[list[tuple[int, int, int]]]:
    """Runs of each of several texts given as words."""
    if min_words < MIN_WORDS or exponent < MIN_EXPONENT:
        raise ValueError(f"runs of fewer than {MIN_WORDS} words or {MIN_EXPONENT} periods are cut off")
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts])
    if not sizes.sum():
        return found
    word = pd.factorize(np.array([w for t in texts for w in t], dtype=object))[0].astype(np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    place = candidate_places(word, text)
    if not len(place):
        return found
    starts = np.cumsum(sizes) - sizes
    part = _parts(place, text[place])
    for piece in np.split(place, np.flatnonzero(np.diff(part)) + 1):
        k = text[piece[0]]
        offset = int(piece[0] - starts[k])
        ids = _codes(word[piece]).tolist()
        found[k] += [(offset + s, n, q) for s, n, q in sequence_runs(ids, min_words, exponent)]
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """Words outside the repeats of runs: a run keeps its first period."""
    if not runs:
        return b" ".join(words)
    dropped = bytearray(len(words))
    for start, length, period in runs:
        dropped[start + period : start + length] = b"\x01" * (length - period)
    return b" ".join(w for w, gone in zip(words, dropped) if not gone)


def _find(text: int, min_words: int, exponent: int, names: tuple[str, str]):
    def analysed(batch: pa.RecordBatch) -> pa.RecordBatch:
        # bytes.split() cuts at the blanks of the contract, 0x09 to 0x0D and 0x20
        texts = [(t.as_py() or "").encode().split() for t in batch.column(text)]
        runs = text_runs(texts, min_words, exponent)
        left = [collapsed(w, r).decode() for w, r in zip(texts, runs)]
        structs = [[dict(zip(("start", "length", "period"), r)) for r in of] for of in runs]
        return appended(
            batch,
            dict(zip(names, (pa.array(structs, _RUNS), pa.array(left, pa.string())))),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_pylist()
            first = held = 0
            for row, size in enumerate(sizes):
                if row > first and held + size > BATCH_BYTES:
                    yield analysed(batch.slice(first, row - first))
                    first, held = row, 0
                held += size
            if first < batch.num_rows:
                yield analysed(batch.slice(first))

    return run


def with_runs(
    docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, exponent: int = MIN_EXPONENT
) -> DataFrame:
    """``docs`` with ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    ``collapsed`` joins by spaces the words that are left when every run keeps its first
    period. (The names are lengthened by ``_`` where ``docs`` has them.)
    """
    runs, left = fresh(docs, "runs", "collapsed")
    find = _find(docs.columns.index(text), min_words, exponent, (runs, left))
    return docs.mapInArrow(find, extended(docs, f"`{runs}` {_RUNS_DDL}, `{left}` string"))


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """One document in ten, by the crc32 of its id, gets a periodic end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n = F.size("words").cast("long")
    a = F.col("g") % n
    period = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
    placed = cut.withColumns({"n": n}).withColumns(
        {"a": F.when(F.col("n") > 0, a), "period": F.when(F.col("n") > 0, period)}
    )
    as_int = lambda c: F.col(c).cast("int")
    left = as_int("n") - as_int("a")
    tail = F.slice("words", as_int("a") + 1, as_int("period"))
    times = F.ceil(left / as_int("period")).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(tail, times)), F.lit(1), left)
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), as_int("a")), repeated), " ")
    return placed.select(
        "doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text")
    )


def _greatest(runs: Column) -> Column:
    """The run with the greatest length / period; ties: smallest start, then period."""
    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        # runs come by start and period, so the first of equals stays
        return F.when(best.isNull() | more, run).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, better)


def op12_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs, its strongest run and digests of the runs and of what is left."""
    docs = _with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = with_runs(docs).withColumn("best", _greatest(F.col("runs")))
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
