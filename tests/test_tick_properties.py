"""Random tick payloads: the Spark validator against a plain-Python statement of the rules."""

import json
import math
import re

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barlake.functions.ticks import reject_reason, with_tick_check
from barlake.schemas import REQUIRED_TICK_FIELDS, TICK_REASONS

ISO = re.compile(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$")

VALUES = st.one_of(
    st.none(),
    st.booleans(),
    st.integers(min_value=-(10**20), max_value=10**20),
    st.floats(allow_nan=False, allow_infinity=False, width=32),
    st.sampled_from(["", "   ", "AAPL", "aapl", "1.5", "10", "yesterday", "2026", "14:30:00",
                     "2026-07-07", "2026-07-07T14:30:00+00:00", "2026-07-07T14:30:00Z",
                     "2026-13-45T99:99:00", "live", "replay", "manual"]),
    st.lists(st.integers(), max_size=2),
)


def python_reason(msg) -> str:
    """The rules in order, on a decoded JSON value."""
    if not isinstance(msg, dict):
        return "payload is not a JSON object"
    missing = [f for f in REQUIRED_TICK_FIELDS if f not in msg]
    if missing:
        return TICK_REASONS["missing_prefix"] + ", ".join(missing)
    t = msg["ticker"]
    if not isinstance(t, str) or t.strip(" ") == "":
        return TICK_REASONS["ticker"]
    p = msg["price"]
    if isinstance(p, bool) or not isinstance(p, (int, float)):
        return TICK_REASONS["price_type"]
    if p <= 0:
        return TICK_REASONS["price_sign"]
    v = msg["volume"]
    # integral JSON numbers: 100 and 100.0 count; 1.5 does not, nor exponent
    # notation (Python writes 1e+20 for 1e20), which JSON typing makes a double
    integral_float = isinstance(v, float) and v.is_integer() and "e" not in repr(v)
    if isinstance(v, bool) or not (isinstance(v, int) or integral_float):
        return TICK_REASONS["volume_type"]
    v = int(v)
    if not (-(2**63) <= v < 2**63):
        return TICK_REASONS["volume_type"]
    if v < 0:
        return TICK_REASONS["volume_sign"]
    e = msg["event_time"]
    if not isinstance(e, str) or not ISO.match(e.strip()) or not _parses(e.strip()):
        return TICK_REASONS["time"]
    if msg["source"] not in ("live", "replay"):
        return TICK_REASONS["source"]
    return TICK_REASONS["ok"]


def _parses(text: str) -> bool:
    import datetime as dt

    try:
        dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
        return True
    except ValueError:
        return False


BASE = {
    "ticker": "AAPL",
    "price": 1.5,
    "volume": 10,
    "event_time": "2026-07-07T14:30:00+00:00",
    "source": "live",
    "producer_id": "p1",
}
FIELDS = list(REQUIRED_TICK_FIELDS)


def _mutate(changes: dict, dropped: list) -> dict:
    msg = {**BASE, **changes}
    for f in dropped:
        msg.pop(f, None)
    return msg


# a valid message with up to two fields replaced by random JSON values and
# sometimes one field dropped, so every rule in the order gets reached
MESSAGES = st.builds(
    _mutate,
    st.dictionaries(st.sampled_from(FIELDS), VALUES, max_size=2),
    st.lists(st.sampled_from(FIELDS), max_size=1),
)
SETTINGS = settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck),
                    phases=[Phase.explicit, Phase.reuse, Phase.generate])


@SETTINGS
@given(st.lists(st.one_of(MESSAGES, MESSAGES, MESSAGES, VALUES), min_size=5, max_size=60))
def test_validator_matches_python_rules(spark, payloads):
    texts = [json.dumps(p) for p in payloads]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string")
    staged = {r.i: r.reason for r in with_tick_check(df, "raw").collect()}
    single = {r.i: r.reason for r in df.select("i", reject_reason(F.col("raw")).alias("reason")).collect()}
    for i, p in enumerate(payloads):
        want = python_reason(p)
        if isinstance(p, float) and (math.isnan(p) or math.isinf(p)):
            continue
        assert staged[i] == want, (texts[i], staged[i], want)
        assert single[i] == staged[i]
