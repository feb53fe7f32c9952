"""SimHash near-duplicates, found by Golay-code fuzzy hashing.

A 64-bit fingerprint is three segments of 23, 23 and 18 bits. Two fingerprints at
most two bits apart have their errors spread so that, going round the segments,
some segment is equal and the next one has at most one error; a segment with at
most one error shares one of its Golay codeword indices. So the keys (segment as
it is, codeword index of the next) of a fingerprint, up to six for each of the
three segments, meet those of every fingerprint it can link to. The join on the
keys is verified on the bits.

Equal fingerprints are one row before any join. A key that more than ``HOT_KEY``
different fingerprints share is not joined within itself: its fingerprints go to
a finer join on 14 of their 16 four-bit parts (120 choices of the other two),
where two errors always leave a shared choice and no group can have more than 256
different members.

Defined cases: a null or wordless text has fingerprint zero and links like any
other; rows that repeat a doc_id count each; a null doc_id is never a class's
smallest id unless the class has no other; an empty table gives an empty result;
other columns of the input stay in ``near_duplicates`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import golay
from barlake.llm.common import appended, extended, fresh, table, written
from barlake.llm.components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
HOT_KEY = 64
SEGMENTS = ((0, 23), (23, 23), (46, 18))  # (lowest bit, bits)
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the text's word shingles, each as often as it occurs."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    runs = zip(*(words[k:] for k in range(size)))
    digest, join = xxhash.xxh64_intdigest, b" ".join
    n = len(words) - size + 1
    hashes = np.fromiter((digest(join(run), SEED) for run in runs), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        octets = hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprints(
    docs: DataFrame, column: str, text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """``docs`` with the fingerprint of its text as a signed 64-bit column."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in batch.column(place)),
                dtype=np.uint64, count=batch.num_rows,
            )
            yield appended(batch, {column: pa.array(prints.view(np.int64))})

    return docs.mapInArrow(run, extended(docs, f"`{column}` long"))


def _fuzzy_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy().view(np.uint64)
        parts = [
            (prints >> np.uint64(low) & np.uint64((1 << bits) - 1)).astype(np.int64)
            for low, bits in SEGMENTS
        ]
        for k, exact in enumerate(parts):
            near = golay.codeword_keys(parts[(k + 1) % 3])
            keys = (k << 35) + (exact[:, None] << golay.DATA) + near
            row, column = np.nonzero(near >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[row, column]), pa.array(prints.view(np.int64)[row])],
                names=["key", "print"],
            )


def _fine_masks() -> list[int]:
    whole = (1 << 64) - 1
    return [whole ^ (15 << 4 * a) ^ (15 << 4 * b) for a, b in combinations(range(16), 2)]


def _meet(keyed: DataFrame, by: list[str], max_bits: int) -> DataFrame:
    """Pairs of different fingerprints that share a key and differ in few bits."""
    left = keyed.select(*by, F.col("print").alias("a"))
    right = keyed.select(*by, F.col("print").alias("b"))
    return left.join(right, by).where(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    ).select("a", "b")


def links(prints: DataFrame, max_bits: int = MAX_BITS, hot_key: int = HOT_KEY) -> DataFrame:
    """All pairs (a, b) of the distinct fingerprints ``prints`` within ``max_bits`` <= 2."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the keys hold for distances up to 2")
    keyed = written(prints.mapInArrow(_fuzzy_keys, "key long, print long"), "fuzzy-keys")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = keyed.join(sizes, "key")
    cold = _meet(met.where(F.col("n") <= hot_key), ["key"], max_bits)
    hot = met.where(F.col("n") > hot_key).select("print").distinct()
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in _fine_masks()])
    fine = hot.select("print", F.posexplode(masks).alias("choice", "mask")).select(
        "choice", F.col("print").bitwiseAND(F.col("mask")).alias("part"), "print"
    )
    return cold.union(_meet(fine, ["choice", "part"], max_bits))


def classes(marked: DataFrame, mark: str, doc_id: str, max_bits: int = MAX_BITS) -> DataFrame:
    """(node, root, class_id) for every distinct fingerprint of ``marked``."""
    groups = written(
        marked.groupBy(F.col(mark).alias("node")).agg(F.min(doc_id).alias("low")), "groups"
    )
    prints = groups.select(F.col("node").alias("print"))
    rooted = written(components(links(prints, max_bits)), "components")
    joined = groups.join(rooted, "node", "left").select(
        "node", "low", F.coalesce("root", "node").alias("root")
    )
    lowest = joined.groupBy("root").agg(F.min("low").alias("class_id"))
    return written(joined.join(lowest, "root").select("node", "root", "class_id"), "classes")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``docs`` without its text, with fingerprint (16 hex digits) and component_id.

    The class id is the smallest doc_id that links reach, the row's own included.
    """
    mark, name, label = fresh(docs, "print", "fingerprint", "component_id")
    marked = written(with_fingerprints(docs, mark, text, shingle).drop(text), "fingerprints")
    found = classes(marked, mark, doc_id, max_bits)
    return marked.join(found, marked[mark] == found["node"]).select(
        *[marked[c] for c in marked.columns if c != mark],
        F.lpad(F.lower(F.hex(marked[mark])), 16, "0").alias(name),
        found["class_id"].alias(label),
    )


def one_of_each(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``docs`` with one row of each class, that of the smallest doc_id.

    Of rows that repeat that id the first in the table stays; an id comes before null.
    """
    mark, row = fresh(docs, "print", "row")
    marked = with_fingerprints(docs, mark, text, shingle)
    marked = written(marked.withColumn(row, F.monotonically_increasing_id()), "marked")
    found = classes(marked.select(doc_id, mark), mark, doc_id, max_bits)
    first = F.min(F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.col(row).alias("row")))
    stays = (
        marked.select(doc_id, row, mark).join(found, F.col(mark) == found["node"])
        .groupBy("root").agg(first.alias("first")).select(F.col("first.row").alias("stays"))
    )
    return marked.join(stays, marked[row] == stays["stays"], "left_semi").drop(mark, row)


def op8_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "fingerprint", "component_id")
