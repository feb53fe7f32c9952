"""Time expressions that stay independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType



def instant_to_ntz(ts: Column) -> Column:
    """A ``TIMESTAMP`` (an instant) as its naive UTC wall clock.

    Goes through epoch microseconds, never through the session's local time,
    which is ambiguous for an hour each autumn where clocks fall back.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch)


def as_ntz(col: Column, dtype: DataType) -> Column:
    """Coerce a date/time-like column to naive UTC ``TIMESTAMP_NTZ``; bad values become null.

    Strings with a zone offset are moved to UTC, strings without one are taken
    as UTC wall-clock time. ``TIMESTAMP`` values are shown in UTC.
    """
    if isinstance(dtype, TimestampNTZType):
        return col
    if isinstance(dtype, TimestampType):
        return instant_to_ntz(col)
    if isinstance(dtype, DateType):
        return col.cast("timestamp_ntz")
    if isinstance(dtype, StringType):
        return iso_string_to_ntz(col)
    return col.try_cast("string").try_cast("timestamp_ntz")


# Accepted text forms: a date, optionally followed by a time, optionally with
# fractions and a zone offset or "Z". Spark's parser alone also takes words
# such as "yesterday" or a bare year, which are not ISO-8601 timestamps.
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"


def iso_string_to_ntz(col: Column) -> Column:
    """ISO-8601 text -> naive UTC timestamp; null when not ISO-8601."""
    text = F.trim(col)
    # minute precision ("14:30", "14:30Z", "14:30+05:30"): add ":00" seconds,
    # which Spark's parser needs before a zone
    full = F.regexp_replace(text, r"([T ]\d{2}:\d{2})(?=Z|[+-]|$)", "$1:00")
    # the shape regex has passed, so a zone is a trailing Z or a sign after the
    # time part (position 12 on); plain string functions, no second regex
    has_zone = (F.length(text) > 10) & (
        text.endswith("Z") | (F.locate("+", text, 12) > 0) | (F.locate("-", text, 12) > 0)
    )
    # With a zone: parse to an instant and show it in UTC. Without: wall clock.
    zoned = instant_to_ntz(F.try_to_timestamp(full))
    naive = full.try_cast("timestamp_ntz")
    return F.when(~text.rlike(ISO_PATTERN), F.lit(None).cast("timestamp_ntz")).when(
        has_zone, zoned
    ).otherwise(naive)


def ntz_literal(value) -> Column:
    """A naive datetime/date as a ``TIMESTAMP_NTZ`` literal, independent of the
    Python process's and the session's time zones."""
    text = value.isoformat(sep=" ") if hasattr(value, "hour") else str(value)
    return F.lit(text).cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 for a ``TIMESTAMP_NTZ`` value."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def day_start(ts: Column) -> Column:
    """Midnight of the same day, keeping the NTZ type (no session-zone round trip)."""
    return F.to_date(ts).cast("timestamp_ntz")


def date_id(ts: Column) -> Column:
    """YYYYMMDD integer key of a timestamp."""
    return F.date_format(ts, "yyyyMMdd").cast("int")


def iso_text(ts: Column) -> Column:
    """Naive UTC timestamp as ISO-8601 text with an explicit +00:00 offset."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
