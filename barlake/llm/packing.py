"""Best-fit packing of documents into sequences after Martello-Toth reduction.

Every document becomes its ids and an end id; one longer than a sequence is cut
from its end into whole sequences, so that only its first piece may be shorter.
A length is at most the sequence length, so the instance is a histogram with that
many numbers, whatever the corpus: the driver plans on the histogram, and the
plan's runs ("pieces lo..hi of length w go to sequences from b on") are applied
where the pieces are.

Reduction: a set of lengths that dominates every other set with its largest
piece is fixed for good - an exact complement; the only partner that fits; or the
best pair of partners, when no other pair could be better. What is left is packed
best-fit, longest first.

Defined cases: a null text is empty and has the end id alone; rows that repeat a
doc_id are packed each; null ids stay; an empty table gives no pieces; other
columns of the input are not carried.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm.common import table, written
from barlake.llm.tokens import encoder

SEQUENCE = 2048
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, shard int, rank long"


@dataclass
class Plan:
    """Runs of pieces: (length, first rank, end rank, first sequence, per sequence, offset)."""

    counts: list[int]
    capacity: int
    runs: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    reduced: int = 0

    def __post_init__(self) -> None:
        self.left = list(self.counts)
        self.next_rank = [0] * len(self.counts)

    def place(self, length: int, bins: int, first: int, each: int, offset: int) -> None:
        """The next ``bins * each`` pieces of a length go to ``bins`` sequences."""
        lo = self.next_rank[length]
        hi = lo + bins * each
        self.runs.append((length, lo, hi, first, each, offset))
        self.next_rank[length] = hi
        self.left[length] -= hi - lo

    def fix(self, lengths: list[int], times: int) -> None:
        """``times`` sequences that hold exactly these lengths."""
        offset = 0
        for length in lengths:
            self.place(length, times, self.sequences, 1, offset)
            offset += length
        self.sequences += times
        self.reduced += times


def _times(left: list[int], lengths: list[int]) -> int:
    return min(left[w] // lengths.count(w) for w in lengths)


def _smallest(left: list[int], above: int, how_many: int) -> list[int]:
    """The smallest lengths over ``above`` that are left, repeats included."""
    found: list[int] = []
    for length in range(above + 1, len(left)):
        found += [length] * min(left[length], how_many - len(found))
        if len(found) == how_many:
            break
    return found


def _largest(left: list[int], most: int, without: tuple[int, ...] = ()) -> int:
    """The largest length up to ``most`` of which one is left besides ``without``; 0: none."""
    for length in range(min(most, len(left) - 1), 0, -1):
        if left[length] > without.count(length):
            return length
    return 0


def dominant_set(left: list[int], capacity: int, j: int) -> list[int] | None:
    """A set with ``j`` that dominates every feasible set with ``j``, if one is provable.

    A set dominates another if the other's pieces can be grouped so that each
    group is no longer than a piece of its own in the first set.
    """
    room = capacity - j
    others = list(left)
    others[j] -= 1
    if 0 < room < len(others) and others[room]:
        return [j, room]  # fills the sequence: all partners of j together are no longer
    low = _smallest(others, 0, 3)
    if not low or low[0] > room:
        return [j]
    best = _largest(others, room)
    if len(low) < 2 or low[0] + low[1] > room:
        return [j, best]  # one partner at most: the longest
    if len(low) == 3 and sum(low) <= room:
        return None  # three partners fit: no rule
    second = _largest(others, room - best, (best,))
    if not second:
        # best alone fills up; a pair is no better only if it is no longer than best
        pair = _smallest(others, 0, 2)
        longest_pair = max(
            (a + b for a in range(1, room) if others[a]
             for b in [_largest(others, room - a, (a,))] if b),
            default=sum(pair),
        )
        return [j, best] if longest_pair <= best else None
    # pairs of two pieces both longer than `second` are the only rivals
    rivals = _smallest(others, second, 2)
    if len(rivals) < 2 or rivals[0] + rivals[1] > room:
        return [j, best, second]
    return None


def reduce_instance(plan: Plan) -> None:
    """Fix dominating sets, from the longest pieces down, until none is provable."""
    capacity = plan.capacity
    changed = True
    while changed:
        changed = False
        for j in range(capacity, 0, -1):
            while plan.left[j]:
                found = dominant_set(plan.left, capacity, j)
                if found is None:
                    break
                plan.fix(found, _times(plan.left, found))
                changed = True


def best_fit(plan: Plan) -> None:
    """Best-fit decreasing over groups of sequences with the same free room."""
    by_room: dict[int, list[list[int]]] = {}  # room -> [first sequence, sequences]
    rooms: list[int] = []

    def keep(room: int, first: int, bins: int) -> None:
        if room and bins:
            if room not in by_room:
                bisect.insort(rooms, room)
                by_room[room] = []
            by_room[room].append([first, bins])

    for length in range(plan.capacity, 0, -1):
        while plan.left[length]:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, bins = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
                    rooms.pop(at)
            else:
                room, first = plan.capacity, plan.sequences
                bins = -(-plan.left[length] // (plan.capacity // length))
                plan.sequences += bins
            each = room // length  # a sequence that has taken a piece is the best fit again
            full = min(bins, plan.left[length] // each)
            offset = plan.capacity - room
            if full:
                plan.place(length, full, first, each, offset)
                keep(room - each * length, first, full)
            part = min(plan.left[length], each - 1) if full < bins else 0
            if part:
                plan.place(length, 1, first + full, part, offset)
                keep(room - part * length, first + full, 1)
            rest = full + bool(part)
            keep(room, first + rest, bins - rest)


def plan_packing(counts: dict[int, int], capacity: int = SEQUENCE) -> Plan:
    """Where the pieces of each length go, from how many there are."""
    plan = Plan([counts.get(w, 0) for w in range(capacity + 1)], capacity)
    reduce_instance(plan)
    best_fit(plan)
    return plan


def _cut(vocabulary: str, capacity: int):
    names = [f.split()[0] for f in _PIECES.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encode = encoder(vocabulary).ids
        ranks = [0] * (capacity + 1)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = memoryview(encode(text.as_py()))
                n = len(ids) // 4
                start, end, piece = 0, (n - 1) % capacity + 1, 0
                while start < n:
                    length = end - start
                    crc = zlib.crc32(ids[4 * start : 4 * end])
                    rows.append((doc_id, piece, start, length, crc, shard, ranks[length]))
                    ranks[length] += 1
                    start, end, piece = end, end + capacity, piece + 1
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, type=t) for v, t in zip(columns, types)], names=names
            )

    return run


def _placed(runs: list[tuple[int, int, int, int, int, int]]):
    """Look up each piece's run; there are a few thousand runs at most."""
    ordered = np.array(sorted(runs), dtype=np.int64).reshape(-1, 6)
    # ranks are below 2**48 and lengths below 2**15
    begins = (ordered[:, 0] << 48) + ordered[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            mine = ordered[np.searchsorted(begins, (length << 48) + rank, side="right") - 1]
            nth = rank - mine[:, 1]
            sequence = mine[:, 3] + nth // mine[:, 4]
            offset = mine[:, 5] + nth % mine[:, 4] * length
            kept = batch.select([*batch.schema.names[:-1]])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*kept.schema.names, "sequence_id", "offset"],
            )

    return run


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = SEQUENCE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = written(rows.mapInArrow(_cut(vocabulary, capacity), _PIECES), "pieces")
    counts = pieces.groupBy("shard", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_packing(histogram, capacity)
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "shard", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ranked = pieces.join(offsets, ["shard", "length"]).select(
        *columns, (F.col("rank") + F.col("before")).alias("rank")
    )
    return ranked.mapInArrow(
        _placed(plan.runs),
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )


def op10_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(table(spark, sf_dir, "documents"), vocabulary)
