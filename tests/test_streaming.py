"""Streaming lane on the file source: batch twin, dead letters, restart, late data."""

import json
import os
import time

from pyspark.sql import functions as F

from barlake.operators.bars import ohlcv_bars, with_reference_average
from barlake.sources import testdata as src
from barlake.sources.warehouse import Warehouse
from barlake.streaming.monitor import check, is_healthy, lag_from_progress
from barlake.streaming.processor import StreamConfig, start

from .conftest import SF_SMALL


def land(spark, messages, folder, parts=4):
    """Write messages as text files, one slice after another in event-time order."""
    os.makedirs(folder, exist_ok=True)
    rows = messages.orderBy("event_id").select("value").collect()
    size = (len(rows) + parts - 1) // parts
    start_idx = len([f for f in os.listdir(folder)])
    for i in range(parts):
        chunk = rows[i * size:(i + 1) * size]
        if not chunk:
            continue
        with open(os.path.join(folder, f"part-{start_idx + i:05d}.txt"), "w") as fh:
            for r in chunk:
                fh.write((r.value or "") + "\n")
        time.sleep(0.05)


def run(spark, cfg):
    dlq_q, bars_q = start(spark, cfg)
    dlq_q.awaitTermination(300)
    bars_q.awaitTermination(300)
    return dlq_q, bars_q


def cfg_for(tmp_path, landing):
    return StreamConfig(
        warehouse=str(tmp_path / "wh"),
        checkpoint_root=str(tmp_path / "ckpt"),
        dlq_path=str(tmp_path / "dlq"),
        landing=landing,
        available_now=True,
        lookback_seconds=5 * 3600,
    )


def test_stream_equals_batch_twin_and_dlq_is_complement(spark, tmp_path):
    msgs = src.tick_messages(spark, SF_SMALL, with_faults=True)
    landing = str(tmp_path / "landing")
    land(spark, msgs, landing)
    run(spark, cfg_for(tmp_path, landing))

    wh = Warehouse(spark, str(tmp_path / "wh"))
    stream_bars = wh.read("fact_intraday_bars")
    # the batch twin over the same valid ticks
    valid_ids = (msgs.where(F.col("event_id") % 40 >= 10)).select("event_id")
    ticks = src.event_ticks(spark, SF_SMALL).join(valid_ids, "event_id")
    twin = with_reference_average(ohlcv_bars(ticks), 5 * 3600)
    max_ts = ticks.agg(F.max("event_time")).collect()[0][0]
    # the last open window stays open under the watermark at the end of a finite stream
    final = twin.where(F.col("window_end") <= F.lit(max_ts) - F.expr("INTERVAL 30 SECONDS"))
    cols = ["ticker", "window_start", "open", "high", "low", "close", "volume", "tick_count"]
    got = sorted(tuple(r) for r in stream_bars.select(*cols).collect())
    want = sorted(tuple(r) for r in final.select(*cols).collect())
    assert got == want
    assert stream_bars.count() == final.count()

    # no message lost: valid + dead letters = input
    dlq = spark.read.json(str(tmp_path / "dlq"))
    n_valid = msgs.where(F.col("event_id") % 40 >= 10).count()
    assert dlq.count() + n_valid == msgs.count()
    assert dlq.where(F.col("reason") == "ok").count() == 0

    metrics = wh.read("bar_metrics").agg(F.sum("inserted")).collect()[0][0]
    assert metrics == stream_bars.count()
    # alerts were raised against the trailing reference
    assert wh.read("alerts").count() > 0


def test_restart_does_not_duplicate(spark, tmp_path):
    msgs = src.tick_messages(spark, SF_SMALL, with_faults=False)
    landing = str(tmp_path / "landing")
    first = msgs.where(F.col("event_id") < 500)
    land(spark, first, landing, parts=2)
    cfg = cfg_for(tmp_path, landing)
    run(spark, cfg)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    n1 = wh.read("fact_intraday_bars").count()
    # restart on the same checkpoint with new files
    land(spark, msgs.where(F.col("event_id") >= 500), landing, parts=2)
    run(spark, cfg)
    bars = wh.read("fact_intraday_bars")
    assert bars.count() > n1
    assert bars.groupBy("ticker", "window_start").count().where("count > 1").count() == 0
    # a fresh checkpoint replays everything; stored bars are skipped, not duplicated
    cfg2 = cfg_for(tmp_path, landing)
    cfg2.checkpoint_root = str(tmp_path / "ckpt2")
    run(spark, cfg2)
    bars = wh.read("fact_intraday_bars")
    assert bars.groupBy("ticker", "window_start").count().where("count > 1").count() == 0


def test_late_tick_is_dropped(spark, tmp_path):
    landing = str(tmp_path / "landing")
    os.makedirs(landing)

    def tick(ts, price):
        return json.dumps({"ticker": "AAPL", "price": price, "volume": 1, "event_time": ts,
                           "source": "live", "producer_id": "t"})

    files = [
        [tick("2026-01-01T10:00:10+00:00", 10.0)],
        [tick("2026-01-01T10:05:00+00:00", 11.0)],  # watermark moves to 10:04:30
        [tick("2026-01-01T10:06:00+00:00", 12.0)],
        [tick("2026-01-01T10:00:20+00:00", 99.0)],  # late for the 10:00 window
        [tick("2026-01-01T10:09:00+00:00", 13.0)],
    ]
    for i, lines in enumerate(files):
        with open(os.path.join(landing, f"f{i}.txt"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
        os.utime(os.path.join(landing, f"f{i}.txt"), (1_000_000 + i, 1_000_000 + i))
    cfg = cfg_for(tmp_path, landing)
    cfg.max_files_per_trigger = 1
    from barlake.streaming.monitor import ProgressTracker

    tracker = ProgressTracker()
    dlq_q, bars_q = start(spark, cfg, tracker)
    dlq_q.awaitTermination(300)
    bars_q.awaitTermination(300)
    time.sleep(1.0)
    spark.streams.removeListener(tracker)
    bars = {r.window_start.minute: r for r in Warehouse(spark, cfg.warehouse).read("fact_intraday_bars").collect()}
    assert bars[0].high == 10.0 and bars[0].tick_count == 1  # the late 99.0 never entered
    assert tracker.dropped_late["intraday_bars"] >= 1  # and Spark counted it as dropped


def test_health_rules():
    assert is_healthy(None) and is_healthy(1000) and not is_healthy(1001)
    progress = {"sources": [{"metrics": {"maxOffsetsBehindLatest": "1500"}}]}
    assert lag_from_progress(progress) == 1500
    assert check(progress)["healthy"] is False
    progress = {"sources": [{"latestOffset": {"t": {"0": 10, "1": 5}}, "endOffset": {"t": {"0": 8, "1": 5}}}]}
    assert lag_from_progress(progress) == 2
    assert lag_from_progress({"sources": [{"endOffset": {"logOffset": 3}}]}) is None


def test_replay_landing_feeds_the_stream(spark, tmp_path):
    from barlake.operators.replay import replay_messages, replay_schedule
    from barlake.sources.bronze import replay_rows
    from barlake.streaming.landing import land_in_order

    feed = src.price_feed(spark, SF_SMALL).withColumnRenamed("Ticker", "ticker")
    rows = replay_rows(feed, order_col="seq")
    sched = replay_schedule(rows, F.lit("2026-01-01 09:30:00").cast("timestamp_ntz"), 10.0)
    msgs = replay_messages(sched, "replay-1")
    landing = str(tmp_path / "landing")
    assert land_in_order(msgs, landing, 400) == (rows.count() + 399) // 400
    cfg = cfg_for(tmp_path, landing)
    cfg.max_files_per_trigger = 4
    run(spark, cfg)
    dlq = spark.read.json(str(tmp_path / "dlq")) if os.path.exists(str(tmp_path / "dlq")) else None
    assert dlq is None or dlq.count() == 0
    bars = Warehouse(spark, cfg.warehouse).read("fact_intraday_bars")
    # every tick of a window the watermark has closed is in a bar, none twice
    last = sched.agg(F.max("event_time")).collect()[0][0]
    cut = F.lit(last) - F.expr("INTERVAL 30 SECONDS")
    closed = sched.where(F.date_trunc("minute", "event_time") + F.expr("INTERVAL 1 MINUTE") <= cut)
    assert bars.agg(F.sum("tick_count")).collect()[0][0] == closed.count() > 0


def test_progress_tracker_sees_both_queries(spark, tmp_path):
    from barlake.streaming.monitor import ProgressTracker

    landing = str(tmp_path / "landing")
    land(spark, src.tick_messages(spark, SF_SMALL, with_faults=True), landing, parts=2)
    tracker = ProgressTracker()
    dlq_q, bars_q = start(spark, cfg_for(tmp_path, landing), tracker)
    dlq_q.awaitTermination(300)
    bars_q.awaitTermination(300)
    time.sleep(1.0)  # listener events are delivered asynchronously
    spark.streams.removeListener(tracker)
    assert {"dead_letters", "intraday_bars"} <= set(tracker.latest)
    # the file source reports no broker lag: unknown is not unhealthy
    assert check(tracker.latest["intraday_bars"])["healthy"] is True
    assert tracker.latest["intraday_bars"]["numInputRows"] >= 0


def test_processing_time_trigger(spark, tmp_path):
    landing = str(tmp_path / "landing")
    msgs = src.tick_messages(spark, SF_SMALL, with_faults=False)
    land(spark, msgs, landing, parts=2)
    cfg = cfg_for(tmp_path, landing)
    cfg.available_now = False
    cfg.trigger = "1 second"
    dlq_q, bars_q = start(spark, cfg)
    try:
        for q in (dlq_q, bars_q):
            q.processAllAvailable()
        assert bars_q.isActive and bars_q.lastProgress is not None
    finally:
        dlq_q.stop()
        bars_q.stop()
    n = Warehouse(spark, cfg.warehouse).read("fact_intraday_bars").count()
    assert n > 0
