"""Benchmark decontamination by a prefix-filtered join and exact verification.

An item's windows are its runs of 13 words (all its words, if fewer). A window is
a set of word shingles; containing it whole means containing each of them, so one
shingle is prefix enough, and the rarest one makes the fewest candidates. How rare
a shingle is, is counted over all documents. Where a document has a window's
prefix shingle, the shingle's place in the window gives the only place where the
window can begin; it must lie in the document with its whole length, and there it
is compared word by word.

The benchmark is taken in blocks of at most ``BLOCK_WORDS`` words (longer items
are cut into parts that share 12 words), so what a task holds is bounded however
large the benchmark is; a document's row goes through the blocks one after the
other, stored in between, and gathers its hit words as disjoint spans.

Defined cases: a null or wordless text has no words, no hits and is not
contaminated; items that are null or wordless occur nowhere; items with a null id
are left out; rows that repeat an item count as one item; rows that repeat a
document get a row each; an empty benchmark hits nothing; other columns stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import Rewritten, appended, extended, fresh, table

WINDOW = 13
SHINGLE = 3
BLOCK_WORDS = 500_000
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: runs of ASCII letters and digits and of all other characters."""
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


@dataclass
class Block:
    """Windows of some items; words are numbers from ``vocabulary``."""

    vocabulary: dict[bytes, int]
    windows: np.ndarray  # one row per window, -1 after its end
    lengths: np.ndarray
    items: list[list[str]]  # ids of the items that have the window
    prefixes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] | None = None


def build_block(items: list[tuple[str, list[bytes]]]) -> Block:
    """Different windows of (id, words) items."""
    vocabulary: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[str]] = {}
    for item, words in items:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words]
        for at in range(max(1, len(ids) - WINDOW + 1) if ids else 0):
            found.setdefault(tuple(ids[at : at + WINDOW]), set()).add(item)
    windows = np.full((len(found), WINDOW), -1, dtype=np.int64)
    for row, ids in enumerate(found):
        windows[row, : len(ids)] = ids
    return Block(vocabulary, windows, (windows >= 0).sum(axis=1), [sorted(x) for x in found.values()])


def _codes(ids: np.ndarray, size: int) -> np.ndarray:
    """A number for each run of ``size`` word numbers; -1 where a word is unknown."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    code = ids[:n].copy()
    known = code >= 0
    for k in range(1, size):
        code = (code << 20) + ids[k : n + k]  # a block has fewer than 2**20 words
        known &= ids[k : n + k] >= 0
    return np.where(known, code, -1)


def _window_codes(block: Block, size: int, rows: np.ndarray) -> np.ndarray:
    """Shingle codes of windows, one column per place; -1 past a window's end."""
    padded = block.windows[rows]
    return np.stack(
        [
            np.where(
                (padded[:, at : at + size] >= 0).all(axis=1),
                sum(padded[:, at + k] << 20 * (size - 1 - k) for k in range(size)),
                -1,
            )
            for at in range(WINDOW - size + 1)
        ],
        axis=1,
    )


def _sizes(block: Block) -> dict[int, np.ndarray]:
    """Rows of the windows by the shingle size they are looked up with."""
    short = np.minimum(block.lengths, SHINGLE)
    return {int(s): np.flatnonzero(short == s) for s in np.unique(short)}


def shingles(block: Block) -> dict[int, np.ndarray]:
    """All shingle codes of a block by size, sorted."""
    found = {s: np.unique(_window_codes(block, s, rows)) for s, rows in _sizes(block).items()}
    return {s: codes[codes >= 0] for s, codes in found.items()}


def choose_prefixes(block: Block, frequency: dict[tuple[int, int], int]) -> None:
    """Give every window its rarest shingle, equal ones by their code."""
    block.prefixes = {}
    for size, rows in _sizes(block).items():
        codes = _window_codes(block, size, rows)
        known, place = np.unique(codes, return_inverse=True)
        rare = np.array([frequency.get((size, int(c)), 0) for c in known], dtype=np.float64)
        rare[known < 0] = np.inf
        at = rare[place.reshape(codes.shape)].argmin(axis=1)
        chosen = codes[np.arange(len(rows)), at]
        order = np.argsort(chosen, kind="stable")
        block.prefixes[size] = (chosen[order], at[order], rows[order])


def _numbers(block: Block, words: list[bytes]) -> np.ndarray:
    number = block.vocabulary.get
    return np.fromiter((number(w, -1) for w in words), dtype=np.int64, count=len(words))


def _positions(codes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in ``codes`` whose code is among the sorted ``wanted``."""
    places = np.flatnonzero(codes >= 0)
    if not len(places) or not len(wanted):
        return places[:0]
    slot = np.searchsorted(wanted, codes[places])
    slot[slot == len(wanted)] = 0
    return places[wanted[slot] == codes[places]]


def occurrences(block: Block, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(start, window row) of every occurrence of a window among the words."""
    ids = _numbers(block, words)
    starts, rows = [], []
    for size, (codes, at, row) in block.prefixes.items():
        own = _codes(ids, size)
        places = _positions(own, codes)
        first = np.searchsorted(codes, own[places], side="left")
        many = np.searchsorted(codes, own[places], side="right") - first
        which = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
        start = np.repeat(places, many) - at[which]
        row_of = row[which]
        inside = (start >= 0) & (start + block.lengths[row_of] <= len(ids))
        start, row_of = start[inside], row_of[inside]
        for k in range(WINDOW):  # word by word; what has failed is not looked at again
            wanted = block.windows[row_of, k]
            same = (wanted < 0) | (ids[np.minimum(start + k, len(ids) - 1)] == wanted)
            start, row_of = start[same], row_of[same]
        starts.append(start)
        rows.append(row_of)
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(rows)


def _merged(spans: list[int], starts: np.ndarray, ends: np.ndarray) -> list[int]:
    """Disjoint spans, flat, of the old and the new ones."""
    pairs = sorted([*zip(spans[::2], spans[1::2]), *zip(starts.tolist(), ends.tolist())])
    out: list[int] = []
    for start, end in pairs:
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def benchmark_blocks(
    benchmark: DataFrame, item_id: str, text: str, block_words: int = BLOCK_WORDS
) -> Iterator[Block]:
    """The benchmark's blocks; the driver reads the items through and holds one block."""
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")
    ).where("item IS NOT NULL AND text IS NOT NULL").distinct()
    rows: list[tuple[str, list[bytes]]] = []
    size = 0
    for r in items.toLocalIterator():
        words = words_of(r["text"])
        for at in range(0, max(len(words) - WINDOW + 1, min(len(words), 1)), block_words):
            part = words[at : at + block_words + WINDOW - 1]
            if rows and size + len(part) > block_words:
                yield build_block(rows)
                rows, size = [], 0
            rows.append((r["item"], part))
            size += len(part)
    yield build_block(rows)


def shingle_frequency(docs: DataFrame, text: str, block: Block) -> dict[tuple[int, int], int]:
    """In how many documents each of the block's shingles occurs, over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast((block.vocabulary, shingles(block)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, wanted = shared.value
        number = vocabulary.get
        counts = {s: np.zeros(len(c), dtype=np.int64) for s, c in wanted.items()}
        for batch in batches:
            for value in batch.column(0):
                words = words_of(value.as_py())
                ids = np.fromiter((number(w, -1) for w in words), np.int64, len(words))
                for s, codes in wanted.items():
                    own = _codes(ids, s)
                    found = np.unique(own[_positions(own, codes)])
                    counts[s][np.searchsorted(codes, found)] += 1
        for s, codes in wanted.items():
            some = np.flatnonzero(counts[s])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), s), pa.int32()), pa.array(codes[some]),
                 pa.array(counts[s][some])],
                names=["size", "code", "n"],
            )

    counted = docs.select(text).mapInArrow(run, "size int, code long, n long")
    rows = counted.groupBy("size", "code").agg(F.sum("n").alias("n")).collect()
    return {(r["size"], r["code"]): r["n"] for r in rows}


def mark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with n_words, hit_spans (flat starts and ends) and hit_items.

    (The names lengthened by ``_`` where ``docs`` has them already.)
    """
    names = fresh(docs, "n_words", "hit_spans", "hit_items")
    n_words, hit_spans, hit_items = names
    marked = docs.withColumns(
        {
            n_words: F.lit(0).cast("long"),
            hit_spans: F.array().cast("array<long>"),
            hit_items: F.array().cast("array<string>"),
        }
    )
    place = docs.columns.index(text)
    width = len(docs.columns)
    schema = extended(docs, f"`{n_words}` long, `{hit_spans}` array<long>, `{hit_items}` array<string>")

    def pass_block(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in batches:
                counts, spans, items = [], batch.column(width + 1).to_pylist(), batch.column(width + 2).to_pylist()
                for k, value in enumerate(batch.column(place)):
                    words = words_of(value.as_py())
                    counts.append(len(words))
                    start, row = occurrences(block, words)
                    if len(start):
                        spans[k] = _merged(spans[k], start, start + block.lengths[row])
                        new = {i for r in np.unique(row) for i in block.items[r]}
                        items[k] = sorted(new.union(items[k]))
                columns = {
                    n_words: pa.array(counts, pa.int64()),
                    hit_spans: pa.array(spans, pa.list_(pa.int64())),
                    hit_items: pa.array(items, pa.list_(pa.string())),
                }
                yield appended(batch.select(list(range(width))), columns)

        return run

    context = docs.sparkSession.sparkContext
    store, shared = Rewritten("marked"), None
    for block in benchmark_blocks(benchmark, item_id, item_text, block_words):
        if shared is not None:  # done with the block before
            marked = store.store(marked)
            shared.destroy()
        choose_prefixes(block, shingle_frequency(docs, text, block) if len(block.windows) else {})
        shared = context.broadcast(block)
        marked = marked.mapInArrow(pass_block(shared), schema)
    return marked


def hit_words(spans: str) -> Column:
    """How many words the disjoint spans (flat starts and ends) cover."""
    signed = F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x)


def is_contaminated(n_words: str, spans: str) -> Column:
    """Some words are hit, and a twentieth of all or more."""
    return (hit_words(spans) > 0) & (hit_words(spans) * 20 >= F.col(n_words))


def judged(marked: DataFrame, n_words: str, spans: str, items: str) -> DataFrame:
    """n_hit, n_items, items_sha256 and contaminated from the marks.

    (The names lengthened by ``_`` where ``marked`` has them already.)
    """
    n_hit, n_items, digest, verdict = fresh(marked, "n_hit", "n_items", "items_sha256", "contaminated")
    return marked.withColumns(
        {
            n_hit: hit_words(spans),
            n_items: F.size(items).cast("long"),
            digest: F.sha2(F.array_join(F.array_sort(items), ","), 256),
            verdict: is_contaminated(n_words, spans),
        }
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents of which a twentieth or more is benchmark text."""
    n_words, spans, _ = fresh(docs, "n_words", "hit_spans", "hit_items")
    return mark_hits(docs, benchmark).where(~is_contaminated(n_words, spans)).select(*docs.columns)


def op6_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = mark_hits(docs, table(spark, sf_dir, "benchmark"))
    return judged(marked, "n_words", "hit_spans", "hit_items").select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


OP6_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
),
windows AS (
  SELECT DISTINCT item, len(w[i:i + 12]) AS n, array_to_string(w[i:i + 12], ' ') AS run
  FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i
        FROM item_words WHERE len(w) > 0) s
),
sizes AS (SELECT DISTINCT n FROM windows),
runs AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS run
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM doc_words, sizes WHERE len(w) >= n) s
),
found AS (
  SELECT r.doc_id, r.i, r.n, v.item FROM runs r JOIN windows v ON r.n = v.n AND r.run = v.run
),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM found) s GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM found) s GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM doc_words d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id
"""
