"""Token-id files: documents in id order, ids in Simple-8b blocks.

A file set is a folder that Spark writes and commits, one part file per range of
doc_id. Its rows are blocks of whole documents (a block ends with the document
that brings it to ``BLOCK_IDS`` ids):

* ``shard``, ``block``: place of the part file and of the block in it
* ``before``: ids of the shard's earlier blocks
* ``doc_ids``, ``lengths``: the documents and their id counts, end id included
* ``offsets``: first word of each group of ``GROUP_IDS`` ids; a group decodes alone
* ``words``: the 64-bit words, little-endian

Defined cases: a null or empty text has the end id alone; rows with a null doc_id
come first; rows that repeat a doc_id are ordered by a hash of their text; an
empty table gives an empty file set; other columns are not stored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm import simple8b
from barlake.llm.common import table
from barlake.llm.tokens import encoder
from barlake.session import checkpoint_dir, join_path

BLOCK_IDS = 65_536
GROUP_IDS = 8_192
CACHED_CHUNKS = 1_000_000  # of a worker, about 200 MB
BLOCK_SCHEMA = (
    "shard int, block int, before long, n_ids long, doc_ids array<long>, lengths array<long>, "
    "offsets array<int>, words binary"
)
_BLOCK = pa.schema(
    [
        ("shard", pa.int32()), ("block", pa.int32()), ("before", pa.int64()),
        ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int32())),
        ("words", pa.binary()),
    ]
)
_ROWS = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
     ("ids_crc32", pa.int64())]
)


def pack_block(ids: np.ndarray) -> tuple[list[int], bytes]:
    """Offsets of the groups in words, and all words."""
    offsets, parts, at = [], [], 0
    for start in range(0, len(ids), GROUP_IDS):
        words = simple8b.encode(ids[start : start + GROUP_IDS])
        offsets.append(at)
        parts.append(words.tobytes())
        at += len(words)
    return offsets, b"".join(parts)


def unpack_block(n_ids: int, offsets: list[int], words: bytes) -> np.ndarray:
    """All ids of a block as little-endian unsigned 32-bit integers."""
    packed = np.frombuffer(words, dtype="<u8")
    ends = [*offsets[1:], len(packed)]
    parts = [
        simple8b.decode(packed[a:b], min(GROUP_IDS, n_ids - k * GROUP_IDS))
        for k, (a, b) in enumerate(zip(offsets, ends))
    ]
    return np.concatenate(parts).astype("<u4") if parts else np.zeros(0, dtype="<u4")


def _encode_blocks(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encode = encoder(vocabulary, CACHED_CHUNKS).ids
        block = before = n_ids = 0
        doc_ids: list = []
        lengths: list = []
        parts: list[bytes] = []

        def closed() -> pa.RecordBatch:
            offsets, words = pack_block(np.frombuffer(b"".join(parts), dtype="<u4"))
            row = [[shard], [block], [before], [n_ids], [doc_ids], [lengths], [offsets], [words]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, type=f.type) for v, f in zip(row, _BLOCK)], schema=_BLOCK
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py())
                doc_ids.append(doc_id)
                lengths.append(len(ids) // 4)
                parts.append(ids)
                n_ids += len(ids) // 4
                if n_ids >= BLOCK_IDS:
                    yield closed()
                    block, before, n_ids = block + 1, before + n_ids, 0
                    doc_ids, lengths, parts = [], [], []
        if doc_ids:
            yield closed()

    return run


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Encode every document and write the file set to ``path``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = (
        # equal rows, which may be many, are told apart by their row numbers
        rows.withColumns({"tie": F.xxhash64("text"), "row": F.xxhash64(F.monotonically_increasing_id())})
        .repartitionByRange("doc_id", "tie", "row")
        .sortWithinPartitions("doc_id", "tie", "row")
        .select("doc_id", "text")
    )
    ordered.mapInArrow(_encode_blocks(vocabulary), BLOCK_SCHEMA).write.parquet(path)


def read_token_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks, with the ids of all blocks before them as ``start``.

    The shards' totals are one row per part file, so their running sum and its
    broadcast are bounded by the number of part files.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = (
        blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
        .select("shard", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    )
    return blocks.join(F.broadcast(shards), "shard").select(
        (F.col("base") + F.col("before")).alias("start"),
        "n_ids", "doc_ids", "lengths", "offsets", "words",
    )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            start, n_ids, doc_ids, lengths, offsets, words = (
                batch.column(c)[row].as_py() for c in range(6)
            )
            data = memoryview(unpack_block(n_ids, offsets, words).tobytes())
            starts = (start + np.cumsum([0, *lengths[:-1]])).tolist()
            sums, at = [], 0
            for length in lengths:
                sums.append(zlib.crc32(data[4 * at : 4 * (at + length)]))
                at += length
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.int64()) for v in (doc_ids, starts, lengths, sums)], schema=_ROWS
            )


def token_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a file set: first id's place, id count and crc32 of its ids."""
    return read_token_blocks(spark, path).mapInArrow(
        _digest, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def op2_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents' ids to a file set in the shared folder and read it back."""
    import public_tokenizers

    path = join_path(checkpoint_dir(spark), f"barlake-tokens-{uuid.uuid4().hex}")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    write_token_files(table(spark, sf_dir, "documents"), path, vocabulary)
    return token_documents(spark, path)
