import datetime as dt
import json
import types

from pyspark.sql import functions as F

from barlake.sources.bronze import write_bronze
from barlake.sources.warehouse import Warehouse
from barlake.streaming import landing, monitor
from barlake.streaming.processor import BarSink

RAW = "Date timestamp_ntz, Ticker string, Open double, High double, Low double, Close double, " \
    "`Adj Close` double, Volume bigint"


def test_replay_cli_lands_bronze_in_order(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, 1 + k), t, 1.0, 2.0, 0.5, 1.0 + k, 1.0, 10) for k in range(4) for t in ("A", "B")]
    write_bronze(spark.createDataFrame(rows, RAW), str(tmp_path / "bronze"), "b1")
    code = landing.main([
        "--bronze", str(tmp_path / "bronze"), "--landing", str(tmp_path / "land"), "--rate", "2",
        "--start", "2024-06-01 00:00:00", "--rows-per-slice", "3",
    ])
    assert code == 0
    files = sorted((tmp_path / "land").glob("part-*"), key=lambda p: p.stat().st_mtime_ns)
    ticks = [json.loads(line) for f in files for line in f.read_text().splitlines()]
    assert [(t["ticker"], t["price"]) for t in ticks] == [(t, 1.0 + k) for k in range(4) for t in ("A", "B")]
    assert sorted(t["event_time"] for t in ticks) == [t["event_time"] for t in ticks]


def test_saved_progress_reaches_the_monitor(spark, tmp_path, capsys):
    Warehouse(spark, str(tmp_path / "wh")).ensure_tables(["fact_intraday_bars", "alerts"])
    args = ["--warehouse", str(tmp_path / "wh"), "--checkpoints", str(tmp_path / "ck")]
    assert monitor.main(args) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["lag"] is None

    def query(name, at, behind):
        source = {"metrics": {"maxOffsetsBehindLatest": str(behind)}}
        return types.SimpleNamespace(lastProgress={"name": name, "timestamp": at, "sources": [source]})

    folder = monitor.progress_folder(str(tmp_path / "ck"))
    monitor.save_progress(spark, [query("bars", "2024-01-01T00:00:00Z", 50_000_000), query("dlq", "2024-01-01T00:00:00Z", 1)], folder)
    assert monitor.main(args) == 1
    monitor.save_progress(spark, [query("bars", "2024-01-01T00:00:30Z", 2), types.SimpleNamespace(lastProgress=None)], folder)
    assert monitor.main(args) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["lag"] == 2


def test_retry_without_alerts_removes_the_old_ones(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.ensure_tables(["fact_intraday_bars", "alerts", "bar_metrics"])

    def bars(last):
        rows = [("A", dt.datetime(2024, 1, 1, 10, k), dt.datetime(2024, 1, 1, 10, k + 1), p, p, p, p, 1, 1)
                for k, p in enumerate([100.0, last])]
        return spark.createDataFrame(rows, (
            "ticker string, window_start timestamp_ntz, window_end timestamp_ntz, open double, high double, "
            "low double, close double, volume bigint, tick_count bigint"))

    sink = BarSink(wh, "s1")
    sink(bars(200.0), 0)
    assert wh.read("alerts").count() == 1
    sink(bars(100.1), 0)
    assert wh.read("alerts").count() == 0
    assert wh.read("fact_intraday_bars").agg(F.max("close")).first()[0] == 100.1
