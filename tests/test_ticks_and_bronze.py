import datetime as dt

import pytest
from pyspark.sql import functions as F

from barlake.functions.prices import move_pct, should_alert
from barlake.functions.ticks import build_tick, is_valid, reject_reason
from barlake.operators.replay import replay_schedule
from barlake.sources.bronze import read_bronze, replay_rows, resolve_bronze_root, write_bronze

from .conftest import d


def reasons(spark, payloads):
    df = spark.createDataFrame([(p,) for p in payloads], "raw string")
    return [
        (r.reason, r.ok)
        for r in df.select(reject_reason(F.col("raw")).alias("reason"), is_valid(F.col("raw")).alias("ok")).collect()
    ]


GOOD = {
    "ticker": "AAPL",
    "price": 189.5,
    "volume": 100,
    "event_time": "2026-07-07T14:30:00+00:00",
    "source": "replay",
    "producer_id": "p1",
}


def js(**over):
    import json

    msg = dict(GOOD)
    for k, v in over.items():
        if v is ...:
            msg.pop(k)
        else:
            msg[k] = v
    return json.dumps(msg)


def test_build_tick(spark):
    df = spark.createDataFrame([("  aapl ", 1.5, 10, d(2026, 7, 7))], "t string, p double, v bigint, ts timestamp_ntz")
    r = df.select(build_tick(F.col("t"), F.col("p"), F.col("v"), F.col("ts"), F.lit("p1")).alias("x")).collect()[0].x
    assert r.ticker == "AAPL" and r.source == "replay" and r.volume == 10
    assert r.event_time == "2026-07-07T00:00:00.000000+00:00"


def test_validation_cases(spark):
    cases = [
        (js(), "ok"),
        (js(price=...), "missing fields: price"),
        (js(price=-1), "price must be positive"),
        (js(price="abc"), "price is not numeric"),
        (js(price="1.5"), "price is not numeric"),
        (js(event_time="yesterday"), "event_time is not ISO-8601"),
        (js(event_time="2026"), "event_time is not ISO-8601"),
        (js(event_time="14:30:00"), "event_time is not ISO-8601"),
        (js(source="manual"), "source must be one of ('live', 'replay')"),
        (js(source=None), "source must be one of ('live', 'replay')"),
        (js(source=...), "missing fields: source"),
        (js(producer_id=...), "missing fields: producer_id"),
        (js(ticker="   "), "ticker must be a non-empty string"),
        (js(ticker=123), "ticker must be a non-empty string"),
        (js(volume=1.5), "volume is not numeric"),
        (js(volume=100.0), "ok"),
        (js(volume=1e20), "volume is not numeric"),
        (js(volume=-1), "volume must be non-negative"),
        ('{"price": NaN}', "payload is not a JSON object"),
        ("not json", "payload is not a JSON object"),
        ("[1, 2]", "payload is not a JSON object"),
        ("", "payload is not a JSON object"),
        (js(event_time="2026-07-07"), "ok"),
        (js(source="live", volume=0), "ok"),
    ]
    got = reasons(spark, [c[0] for c in cases])
    for (payload, want), (reason, ok) in zip(cases, got):
        assert reason == want, payload
        assert ok == (want == "ok")


def test_null_payload_is_a_dead_letter(spark):
    df = spark.createDataFrame([(None,)], "raw string")
    assert df.select(is_valid(F.col("raw"))).collect()[0][0] is False


def test_pacing(spark):
    rows = spark.createDataFrame([("A", dt.date(2024, 1, 1 + k)) for k in range(7)], "ticker string, Date date")
    t0 = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    for rate, last in ((10, 600_000), (0.5, 12_000_000), (3, 2_000_000)):
        got = replay_schedule(rows, t0, rate).agg(F.max("event_time")).first()[0]
        assert got == dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=last)
    with pytest.raises(ValueError):
        replay_schedule(rows, t0, 0)


def test_move_and_alert(spark):
    df = spark.createDataFrame([(103.0, 100.0), (97.0, 100.0), (101.0, 100.0), (5.0, 0.0), (5.0, None)], "c double, r double")
    rows = df.select(
        move_pct(F.col("c"), F.col("r")).alias("m"), should_alert(F.col("c"), F.col("r"), 2.0).alias("a")
    ).collect()
    assert rows[0].m == pytest.approx(3.0) and rows[1].m == pytest.approx(-3.0)
    assert [r.a for r in rows] == [True, True, False, False, False]
    assert rows[3].m == 0.0


def test_bronze_target_factory(tmp_path):
    assert resolve_bronze_root("local", str(tmp_path)) == str(tmp_path)
    with pytest.raises(ValueError):
        resolve_bronze_root("s3", str(tmp_path))
    with pytest.raises(ValueError):
        resolve_bronze_root("azure")
    assert resolve_bronze_root("azure", account="acct").startswith("abfss://bronze@acct.")


def test_bronze_layout_roundtrip_and_rerun(spark, tmp_path):
    root = str(tmp_path / "a" / "b" / "bronze")  # nested folders are created
    raw = spark.createDataFrame(
        [(d(2026, 6, 25), "AAPL", 150.0, 10), (d(2026, 6, 26), "AAPL", 154.0, 11)],
        "Date timestamp_ntz, Ticker string, Close double, Volume bigint",
    )
    write_bronze(raw, root, "batch-abc")
    write_bronze(raw, root, "batch-abc")  # same batch again: replaced, not doubled
    back = read_bronze(spark, root)
    assert back.count() == 2
    row = back.orderBy("Date").collect()[1]
    assert (row.ticker, row.year, row.batch_id, row.Close) == ("AAPL", 2026, "batch-abc", 154.0)
    import os

    assert os.path.isdir(os.path.join(root, "ticker=AAPL", "year=2026", "batch_id=batch-abc"))
    rows = replay_rows(back).collect()
    assert len(rows) == 2


def test_replay_prefers_latest_batch(spark, tmp_path):
    import time

    root = str(tmp_path / "bronze")
    schema = "Date timestamp_ntz, Ticker string, Close double, Volume bigint"
    write_bronze(spark.createDataFrame([(d(2026, 1, 2), "A", 1.0, 1)], schema), root, "b1")
    time.sleep(1.1)
    write_bronze(spark.createDataFrame([(d(2026, 1, 2), "A", 2.0, None), (d(2026, 1, 3), "A", None, 1)], schema), root, "b2")
    rows = replay_rows(read_bronze(spark, root)).collect()
    assert [(r.Date, r.price, r.volume) for r in rows] == [(dt.datetime(2026, 1, 2), 2.0, 0)]


def test_bronze_year_modes(spark):
    from barlake.sources.bronze import with_partitions

    raw = spark.createDataFrame(
        [(d(2025, 12, 30), "AAPL", 1.0), (d(2026, 1, 2), "AAPL", 2.0), (d(2025, 6, 1), "MSFT", 3.0)],
        "Date timestamp_ntz, Ticker string, Close double",
    )
    own = {(r.ticker, r.Date.year): r.year for r in with_partitions(raw, "row").collect()}
    assert own == {("AAPL", 2025): 2025, ("AAPL", 2026): 2026, ("MSFT", 2025): 2025}
    latest = {(r.ticker, r.Date.year): r.year for r in with_partitions(raw, "extract").collect()}
    assert latest == {("AAPL", 2025): 2026, ("AAPL", 2026): 2026, ("MSFT", 2025): 2025}
    with pytest.raises(ValueError):
        with_partitions(raw, "other")


def test_bronze_failure_is_not_fatal(spark, tmp_path):
    from barlake.sources.bronze import write_bronze_safely

    blocker = tmp_path / "not-a-dir"
    blocker.write_text("x")  # a file where the Bronze folder should go
    raw = spark.createDataFrame([(d(2026, 1, 2), "AAPL", 1.0)], "Date timestamp_ntz, Ticker string, Close double")
    assert write_bronze_safely(raw, str(blocker / "bronze"), "b1") is False


def test_tag_single_ticker_extract(spark):
    from barlake.operators.transform import tag_ticker, transform_prices

    raw = spark.createDataFrame(
        [(d(2026, 1, 1), 1.0, 2.0, 0.5, 1.5, 1.5, 10)],
        "Date timestamp_ntz, Open double, High double, Low double, Close double, `Adj Close` double, Volume bigint",
    )
    out = transform_prices(tag_ticker(raw, "nvda")).collect()[0]
    assert out.ticker == "NVDA" and out.close_price == 1.5
