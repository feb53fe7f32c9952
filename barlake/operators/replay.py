"""Replay: historical daily rows as a paced tick stream.

The reference loops forever on one thread, sending a tick every 1/rate
seconds with the send time as event time. Here the schedule is computed as a
Spark job: each row's position in (Date, ticker) order gives its event time
``t0 + position / rate``; the rows then become JSON messages written to a
landing folder (or Kafka) that a stream reads at its own pace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.ticks import build_tick, tick_message
from barlake.operators.windows import bucketed_ordinal
from barlake.schemas import REPLAY_SPEED


def replay_schedule(rows: DataFrame, t0: Column, replay_speed: float = REPLAY_SPEED) -> DataFrame:
    """Add ``ordinal`` (position in Date, ticker order) and ``event_time``.

    (ticker, Date) must be unique (see ``bronze.replay_rows``) so the order is
    total and the schedule is the same on every run. Each time is computed from
    its position, so rates that do not divide a second do not drift; beyond a
    million ticks a second some share a microsecond.
    """
    if not replay_speed > 0:
        raise ValueError("the replay rate (ticks per second) must be above zero")
    micros = F.floor(F.col("ordinal") * F.lit(1e6) / F.lit(float(replay_speed)))
    day = F.date_trunc("DAY", "Date")
    ordered = bucketed_ordinal(rows, ["Date", "ticker"], day, "ordinal")
    return ordered.withColumn("event_time", F.timestamp_add("MICROSECOND", micros, t0))


def replay_messages(schedule: DataFrame, producer_id: str = "replay-1") -> DataFrame:
    """Scheduled rows -> keyed JSON tick messages (key = ticker)."""
    tick = build_tick(
        F.col("ticker"), F.col("price"), F.col("volume"), F.col("event_time"), F.lit(producer_id)
    )
    return schedule.select("ordinal", "event_time", *tick_message(tick, F.upper(F.trim("ticker"))))
