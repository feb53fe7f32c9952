"""Every registered query against its DuckDB oracle on the smallest test tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_mod
from barlake.plans import catalog

from .conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()


def norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if hasattr(v, "__float__") and not isinstance(v, (int, bool, str)):
        return repr(float(v))
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry_mod.queries())
    assert set(catalog.ORACLES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry_mod.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(entry_mod.oracle_sql()[name])
    ocols = [c[0] for c in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    assert canon(sdf.columns, srows) == canon(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 0
    assert "reference_avg" in df.columns


ZONE_SENSITIVE = ["tick_parse", "valid_ticks", "coerce_types", "fact_enriched", "bar_reference_avg",
                  "replay_schedule", "dim_date", "dq_date_gaps", "stream_health"]


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_query_is_session_zone_free(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        sdf = entry_mod.queries()[name](spark, SF_SMALL)
        srows = [tuple(r) for r in sdf.collect()]
        assert spark.conf.get("spark.sql.session.timeZone") == "America/Los_Angeles"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.execute(entry_mod.oracle_sql()[name])
    assert canon(sdf.columns, srows) == canon([c[0] for c in res.description], res.fetchall())
