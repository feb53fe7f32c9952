"""ISO-8601 parsing: offsets and fractions against Python, in any session time zone."""

import datetime as dt

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barlake.functions.timecols import iso_string_to_ntz

SETTINGS = settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck),
                    phases=[Phase.explicit, Phase.reuse, Phase.generate])

MOMENTS = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2035, 12, 31))
OFFSETS = st.one_of(st.none(), st.just("Z"), st.integers(min_value=-12 * 4, max_value=14 * 4))
FRACTIONS = st.sampled_from([-1, 0, 3, 6])  # -1: minute precision, no seconds


def render(moment: dt.datetime, offset, digits: int) -> tuple[str, dt.datetime]:
    """ISO text and the naive UTC instant it denotes."""
    if digits < 0:
        base = moment.strftime("%Y-%m-%dT%H:%M")
        wall = moment.replace(second=0, microsecond=0)
    else:
        base = moment.strftime("%Y-%m-%dT%H:%M:%S")
        if digits:
            base += "." + f"{moment.microsecond:06d}"[:digits]
        frac = int((f"{moment.microsecond:06d}"[:digits] or "0").ljust(6, "0"))
        wall = moment.replace(microsecond=frac)
    if offset is None:
        return base, wall
    if offset == "Z":
        return base + "Z", wall
    minutes = offset * 15
    sign = "+" if minutes >= 0 else "-"
    text = f"{base}{sign}{abs(minutes) // 60:02d}:{abs(minutes) % 60:02d}"
    return text, wall - dt.timedelta(minutes=minutes)


@SETTINGS
@given(st.lists(st.tuples(MOMENTS, OFFSETS, FRACTIONS), min_size=1, max_size=30))
def test_iso_parse_matches_python_in_any_zone(spark, cases):
    rows = [render(*c) for c in cases]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i int, s string")
    results = []
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            results.append({r.i: r.t for r in df.select("i", iso_string_to_ntz(F.col("s")).alias("t")).collect()})
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    for i, (text, want) in enumerate(rows):
        assert results[0][i] == want, (text, results[0][i], want)
        assert results[1][i] == want, (text, "LA session", results[1][i], want)


def test_fall_back_hour_in_a_dst_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame(
            [("2026-11-01T08:30:00Z",), ("2026-11-01T09:30:00Z",), ("2026-11-01T01:30:00-08:00",)], "s string"
        )
        got = [r.t for r in df.select(iso_string_to_ntz(F.col("s")).alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2026, 11, 1, 8, 30), dt.datetime(2026, 11, 1, 9, 30), dt.datetime(2026, 11, 1, 9, 30)]
