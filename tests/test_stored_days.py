"""Bitmaps of stored days: equal to the joins they stand for; the log survives a broken load."""

import datetime as dt
import random

from pyspark.sql import functions as F

from barlake.operators.load import existing_keys, load_counts, new_rows
from barlake.operators.stored_days import day_bitmaps, merged_bitmaps, stored_keys
from barlake.sources.warehouse import DaysLog, Warehouse, fact_days

KEYS = "ticker string, price_date timestamp_ntz"


def keys(spark, rows):
    return spark.createDataFrame(rows, KEYS)


def random_days(rng, n):
    out = set()
    for _ in range(n):
        year = rng.choice([1, 1899, 1969, 1970, 2024, 2025, 9999])
        out.add((rng.choice(["A", "B", "HOT", "HOT"]), dt.datetime(year, rng.randint(1, 12), rng.randint(1, 28))))
    return sorted(out)


def test_bitmaps_hold_the_keys(spark):
    rng = random.Random(4)
    one, two = random_days(rng, 300), random_days(rng, 300)
    bitmaps = day_bitmaps(keys(spark, one)).unionByName(day_bitmaps(keys(spark, two + [(None, None), ("A", None)])))
    got = [tuple(r) for r in stored_keys(merged_bitmaps(bitmaps)).collect()]
    assert sorted(got) == sorted(set(one) | set(two))


def test_new_rows_equal_the_anti_join(spark):
    rng = random.Random(5)
    stored, batch = random_days(rng, 200), random_days(rng, 200) + [("NEW", dt.datetime(2024, 1, 1)), (None, dt.datetime(2024, 1, 1)), ("A", None)]
    facts, rows = keys(spark, stored), keys(spark, batch)
    want = {r for r in batch if r not in set(stored)}
    for days in (None, day_bitmaps(facts)):
        assert {tuple(r) for r in new_rows(rows, facts, days=days).collect()} == want
        counts = load_counts(rows, facts, days=days).first()
        assert tuple(counts) == (len(batch), len(want), len(batch) - len(want))
        asked = keys(spark, [("A", None), ("A", None), ("HOT", None)]).select("ticker")
        found = {tuple(r) for r in existing_keys(facts, asked, days).collect()}
        assert found == {r for r in stored if r[0] in ("A", "HOT")}


def test_load_does_not_scan_history(spark, tmp_path):
    facts = keys(spark, random_days(random.Random(6), 50))
    facts.write.parquet(str(tmp_path / "history"))
    day_bitmaps(facts).write.parquet(str(tmp_path / "days"))
    history, days = (spark.read.parquet(str(tmp_path / n)) for n in ("history", "days"))
    batch = keys(spark, [("A", dt.datetime(2024, 1, 1))])
    plan = new_rows(batch, history, days=days)._jdf.queryExecution().executedPlan().toString()
    assert "history" not in plan and plan.count("FileScan") == 1


def fact(spark, rows, batch_id):
    return keys(spark, rows).withColumn("batch_id", F.lit(batch_id))


def test_broken_load_is_made_good(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.ensure_tables(["fact_stock_prices", "stored_days"])
    old = [("A", dt.datetime(2024, 1, k)) for k in (1, 2)]
    wh.append("fact_stock_prices", fact(spark, old, "b0"))  # stored before there was a log

    def held():
        return sorted(tuple(r) for r in stored_keys(merged_bitmaps(fact_days(wh))).collect())

    assert held() == old
    more = [("B", dt.datetime(2024, 1, 3))]
    with DaysLog(wh, "b1", keys(spark, more)):
        wh.append("fact_stock_prices", fact(spark, more, "b1"))
    assert held() == old + more
    lost = [("C", dt.datetime(2024, 1, 4))]
    try:
        with DaysLog(wh, "b2", keys(spark, lost)):
            wh.append("fact_stock_prices", fact(spark, lost, "b2"))
            raise OSError("the driver dies here")
    except OSError:
        pass
    assert held() == old + more + lost
    states = {r["state"] for r in wh.read("stored_days").where("batch_id = 'b2'").collect()}
    assert states == {"days", "void", "end"}
    assert held() == old + more + lost
