"""Corpus pipeline: the stages a document passes on its way to packed sequences.

Each stage takes the documents that its predecessor kept and gives back the
columns of documents; the last one gives the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import decontam, line_dedup, packing, simhash, toxicity
from barlake.llm.common import fresh, ship_package, table, written


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    ship_package(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def delete_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, later repeats of passages deleted; n_chars follows a changed text."""
    shorter = line_dedup.delete_repeated_lines(docs)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed = F.col(fresh(docs, "n_deleted")[0]) > 0
        shorter = shorter.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return shorter.select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    ship_package(spark)
    return simhash.one_of_each(docs, shingle=simhash.SHINGLE, max_bits=simhash.MAX_BITS)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    ship_package(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, with their sequence and place."""
    import public_tokenizers

    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", remove_toxic),
    ("line dedup", delete_lines),
    ("near duplicates", keep_one_of_near_copies),
    ("decontamination", remove_contaminated),
    ("packing", pack),
]

# the learned classifier, the fingerprints and the tokenizer have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
