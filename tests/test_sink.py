"""The foreachBatch sink on its own: retries, overlaps, reads back only what it needs."""

import datetime as dt

from pyspark.sql import functions as F

from barlake.sources.warehouse import Warehouse
from barlake.streaming.processor import BarSink

BARS = "ticker string, window_start timestamp_ntz, window_end timestamp_ntz, open double, " \
    "high double, low double, close double, volume bigint, tick_count bigint"


def bars(spark, rows):
    out = []
    for t, minute, close in rows:
        ws = dt.datetime(2026, 1, 5, 10, 0) + dt.timedelta(minutes=minute)
        out.append((t, ws, ws + dt.timedelta(minutes=1), close, close, close, close, 1, 1))
    return spark.createDataFrame(out, BARS)


def sink(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.ensure_tables(["fact_intraday_bars", "alerts", "bar_metrics"])
    return wh, BarSink(wh, "stream-a", threshold_pct=2.0, lookback_seconds=300)


def test_retried_batch_replaces_its_own_output(spark, tmp_path):
    wh, s = sink(spark, tmp_path)
    batch = bars(spark, [("A", 0, 100.0), ("A", 1, 100.0), ("A", 2, 110.0)])
    s(batch, 0)
    s(batch, 0)  # the same micro-batch again (a retry after a crash)
    stored = wh.read("fact_intraday_bars")
    assert stored.count() == 3
    alerts = wh.read("alerts").collect()
    assert len(alerts) == 1 and alerts[0].close == 110.0
    assert abs(alerts[0].move_pct - 10.0) < 1e-9


def test_overlapping_batch_skips_stored_bars_and_uses_the_stored_tail(spark, tmp_path):
    wh, s = sink(spark, tmp_path)
    s(bars(spark, [("A", 0, 100.0), ("A", 1, 100.0)]), 0)
    # minute 1 again (already stored) plus a new bar; its reference comes from the stored tail
    s(bars(spark, [("A", 1, 999.0), ("A", 2, 103.0)]), 1)
    rows = {r.window_start.minute: r for r in wh.read("fact_intraday_bars").collect()}
    assert rows[1].close == 100.0  # the stored bar was not replaced
    assert rows[2].avg_close_5min == (100.0 + 103.0) / 2
    metrics = {r.batch_id: r for r in wh.read("bar_metrics").collect()}
    assert (metrics[1].bars_in, metrics[1].inserted, metrics[1].skipped, metrics[1].alerts) == (2, 1, 1, 1)


def test_empty_batch_is_a_no_op(spark, tmp_path):
    wh, s = sink(spark, tmp_path)
    s(bars(spark, []), 0)
    assert wh.read("fact_intraday_bars").count() == 0


def test_read_partitions_lists_only_named_folders(spark, tmp_path):
    wh, s = sink(spark, tmp_path)
    s(bars(spark, [("A", 0, 100.0)]), 0)
    day = dt.date(2026, 1, 5)
    assert wh.read_partitions("fact_intraday_bars", "bar_date", [day]).count() == 1
    assert wh.read_partitions("fact_intraday_bars", "bar_date", [day + dt.timedelta(days=3)]).count() == 0
    assert wh.read_partitions("fact_intraday_bars", "bar_date", []).count() == 0
    assert "bar_date" in wh.read("fact_intraday_bars").columns
    assert wh.read("fact_intraday_bars").where(F.col("stream_id") == "stream-a").count() == 1


def test_compaction_keeps_rows_and_leaves_one_folder(spark, tmp_path):
    import os

    from barlake.streaming.processor import compact_day

    wh, s = sink(spark, tmp_path)
    for k in range(4):  # four micro-batches on the same day
        s(bars(spark, [("A", 2 * k, 100.0 + k), ("B", 2 * k, 50.0)]), k)
    before = sorted(tuple(r) for r in wh.read("fact_intraday_bars").select("ticker", "window_start", "close").collect())
    day = dt.date(2026, 1, 5)
    assert compact_day(wh, "fact_intraday_bars", day, str(tmp_path / "stage")) == 8
    after = sorted(tuple(r) for r in wh.read("fact_intraday_bars").select("ticker", "window_start", "close").collect())
    assert after == before
    folder = os.path.join(wh.path("fact_intraday_bars"), "bar_date=2026-01-05")
    assert [d for d in os.listdir(folder) if d.startswith("stream_id=")] == ["stream_id=compacted"]
    # the sink still reads the compacted day back as its tail
    s(bars(spark, [("A", 9, 200.0)]), 4)
    row = [r for r in wh.read("fact_intraday_bars").collect() if r.window_start.minute == 9][0]
    assert row.avg_close_5min == ((102.0 + 103.0) / 2 + 200.0) / 2  # minutes 4 and 6 lie in [4:00, 8:59]


def test_maintenance_cli(spark, tmp_path, capsys):
    import json

    from barlake.plans.maintenance import main

    wh, s = sink(spark, tmp_path)
    s(bars(spark, [("A", 0, 100.0)]), 0)
    s(bars(spark, [("A", 2, 101.0)]), 1)
    code = main(["--warehouse", str(tmp_path / "wh"), "--bar-days-before", "2026-01-06", "--bar-days", "1"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 0 and out["fact_intraday_bars:2026-01-05"] == 2
    assert wh.read("fact_intraday_bars").count() == 2
