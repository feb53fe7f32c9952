"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barlake.llm import (
    decontam, language, line_dedup, maxscore, merkle, packing, pii, secrets, sharding, simhash,
    token_files, toxicity, word_runs,
)
from barlake.llm.common import ship_package

_OPERATORS = {
    "op1_toxicity": toxicity.op1_query,
    "op2_token_files": token_files.op2_query,
    "op3_language": language.op3_query,
    "op4_maxscore": maxscore.op4_query,
    "op5_line_dedup": line_dedup.op5_query,
    "op6_decontamination": decontam.op6_query,
    "op7_hash_tree": sharding.op7_query,
    "op8_simhash": simhash.op8_query,
    "op9_secrets": secrets.op9_query,
    "op10_packing": packing.op10_query,
    "op11_pii": pii.op11_query,
    "op12_word_runs": word_runs.op12_query,
    "op13_merkle": merkle.op13_query,
}


def _query(operator: Callable[[SparkSession, str], DataFrame]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return operator(spark, sf_dir)

    return query


QUERIES = {name: _query(operator) for name, operator in _OPERATORS.items()}

ORACLES = {
    "op4_maxscore": maxscore.OP4_SQL,
    "op5_line_dedup": line_dedup.OP5_SQL,
    "op6_decontamination": decontam.OP6_SQL,
    "op13_merkle": merkle.OP13_SQL,
}
