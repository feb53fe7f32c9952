"""Training-data queries that have SQL, against DuckDB on the smallest tables."""

import duckdb
import pytest

from barlake.llm import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op4_maxscore", "op5_line_dedup", "op6_decontamination"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found = registry.QUERIES[name](spark, FOLDER)
    expected = con.execute(registry.ORACLES[name])
    names = [c[0] for c in expected.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted(map(tuple, found.select(*names).collect()), key=str) == sorted(expected.fetchall(), key=str)
