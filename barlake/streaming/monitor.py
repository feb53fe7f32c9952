"""Stream health: source lag from query progress, and warehouse freshness.

The reference asks the broker for consumer-group lag, which Spark's Kafka
source does not commit; Spark reports it itself in each progress event
(``metrics.maxOffsetsBehindLatest`` for Kafka, ``latestOffset`` vs
``endOffset`` in general). The stream saves its progress beside its checkpoints,
and the monitor reads the newest of each query; a listener keeps it in memory.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from barlake.operators.marts import stream_health
from barlake.schemas import MAX_CONSUMER_LAG
from barlake.session import join_path


def _offset_total(offset) -> int | None:
    """Sum of per-partition offsets of a Kafka-style offset JSON ({topic: {part: n}})."""
    if offset is None:
        return None
    if isinstance(offset, str):
        try:
            offset = json.loads(offset)
        except ValueError:
            return None
    if isinstance(offset, dict):
        total = 0
        for v in offset.values():
            if isinstance(v, dict):
                total += sum(int(x) for x in v.values())
            elif isinstance(v, (int, float)):
                total += int(v)
            else:
                return None
        return total
    return None


def lag_from_progress(progress: dict | None) -> int | None:
    """Messages behind over all sources of one progress event; None when unknown."""
    if not progress:
        return None
    lag = 0
    known = False
    for src in progress.get("sources", []):
        metrics = src.get("metrics") or {}
        if "maxOffsetsBehindLatest" in metrics:
            lag += int(float(metrics["maxOffsetsBehindLatest"]))
            known = True
            continue
        latest, end = _offset_total(src.get("latestOffset")), _offset_total(src.get("endOffset"))
        if latest is not None and end is not None:
            lag += max(0, latest - end)
            known = True
    return lag if known else None


def is_healthy(lag: int | None, max_lag: int = MAX_CONSUMER_LAG) -> bool:
    """Unhealthy only when the lag is known and above the limit."""
    return lag is None or lag <= max_lag


class ProgressTracker(StreamingQueryListener):
    """Keeps the latest progress JSON per query name, and the running total of
    rows dropped as too late by the watermark."""

    def __init__(self):
        self.latest: dict[str, dict] = {}
        self.dropped_late: dict[str, int] = {}

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = json.loads(event.progress.json)
        name = p.get("name") or p.get("id")
        self.latest[name] = p
        late = sum(int(op.get("numRowsDroppedByWatermark", 0)) for op in p.get("stateOperators", []))
        self.dropped_late[name] = self.dropped_late.get(name, 0) + late

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass


def progress_folder(checkpoint_root: str) -> str:
    """Where a stream keeps the progress that the monitor reads."""
    return join_path(checkpoint_root, "progress")


def save_progress(spark, queries, folder: str) -> None:
    """Append the latest progress of each query: one small JSON row per query."""
    events = [q.lastProgress for q in queries]
    rows = [(e["name"], str(e["timestamp"]), json.dumps(e, default=str)) for e in map(_plain, events) if e]
    if rows:
        out = spark.createDataFrame(rows, "name string, at string, progress string")
        out.coalesce(1).write.mode("append").json(folder)


def _plain(progress) -> dict | None:
    """A progress event as a dict, whichever form the session gives it in."""
    if progress is None or isinstance(progress, dict):
        return progress
    return json.loads(progress.json)


def saved_progress(spark, folder: str) -> list[dict]:
    """The newest saved progress of each query; empty when none was saved."""
    try:
        saved = spark.read.schema("name string, at string, progress string").json(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    newest = saved.groupBy("name").agg(F.max_by("progress", "at").alias("progress"))
    return [json.loads(r["progress"]) for r in newest.collect()]


def warehouse_health(bars: DataFrame, alerts: DataFrame) -> DataFrame:
    """Bars total, bars processed in the last 5 minutes, alerts, latest processed_at."""
    return stream_health(bars, alerts, F.localtimestamp().cast("timestamp_ntz"))


def check(query_progress: dict | None, max_lag: int = MAX_CONSUMER_LAG) -> dict:
    lag = lag_from_progress(query_progress)
    return {"lag": lag, "healthy": is_healthy(lag, max_lag)}


def main(argv: list[str] | None = None) -> int:
    """Print stream health as JSON; exit 1 when the saved progress shows too much lag.

    ``--checkpoints`` is the stream's checkpoint root, where it saves its progress;
    ``--progress`` takes one ``StreamingQueryProgress`` JSON file instead.
    """
    import argparse
    import sys

    from barlake.session import build_session
    from barlake.sources.warehouse import Warehouse

    p = argparse.ArgumentParser(description="barlake stream health")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--checkpoints", help="checkpoint root of the stream")
    p.add_argument("--progress", help="file with one progress JSON")
    p.add_argument("--max-lag", type=int, default=MAX_CONSUMER_LAG)
    a = p.parse_args(argv)
    spark = build_session(app_name="barlake-monitor")
    wh = Warehouse(spark, a.warehouse)
    stats = warehouse_health(wh.read("fact_intraday_bars"), wh.read("alerts")).first()
    events = saved_progress(spark, progress_folder(a.checkpoints)) if a.checkpoints else []
    if a.progress:
        with open(a.progress, encoding="utf-8") as fh:
            events.append(json.load(fh))
    lags = [lag for lag in map(lag_from_progress, events) if lag is not None]
    lag = max(lags, default=None)
    verdict = {"lag": lag, "healthy": is_healthy(lag, a.max_lag)}
    report = {**verdict, **{k: stats[k] for k in stats.asDict()}, "max_lag": a.max_lag}
    print(json.dumps(report, default=str))
    sys.stdout.flush()
    return 0 if verdict["healthy"] else 1


if __name__ == "__main__":
    raise SystemExit(main())
