"""Tick message build, parse and validation as Column expressions.

One rule set serves the stream filter, the dead-letter split and the reject
reasons: a message is valid exactly when its reason is ``ok``. Field types are
read from the JSON tokens themselves (``try_parse_json`` + ``schema_of_variant``),
so ``"1.5"`` is text, not a price, and ``1.5`` is not a volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.timecols import iso_string_to_ntz, iso_text
from barlake.schemas import REQUIRED_TICK_FIELDS, TICK, TICK_REASONS, VALID_SOURCES

NOT_AN_OBJECT = "payload is not a JSON object"
TYPED_FIELDS = tuple(n for n in REQUIRED_TICK_FIELDS if n != "producer_id")  # presence is enough there


def _is_number(token_type: Column, value: Column) -> Column:
    """JSON number token: what casts to double and is neither text nor a truth value."""
    return value.isNotNull() & ~token_type.isin("STRING", "BOOLEAN")


def _is_integer(token_type: Column) -> Column:
    """Integral JSON number token (a decimal with scale 0 counts)."""
    return (token_type == "BIGINT") | (
        token_type.startswith("DECIMAL(") & token_type.endswith(",0)")
    )


def _is_object(raw: Column, payload: Column) -> Column:
    """A parsed JSON text is an object when it opens with a brace."""
    return payload.isNotNull() & F.ltrim(raw, F.lit(" \t\r\n")).startswith("{")


def build_tick(
    ticker: Column,
    price: Column,
    volume: Column,
    event_time: Column,
    producer_id: Column,
    source: Column | None = None,
) -> Column:
    """Struct in message field order; ticker trimmed and upper-cased, time as ISO text."""
    return F.struct(
        F.upper(F.trim(ticker)).alias("ticker"),
        price.cast("double").alias("price"),
        volume.cast("bigint").alias("volume"),
        iso_text(event_time).alias("event_time"),
        (source if source is not None else F.lit("replay")).alias("source"),
        producer_id.alias("producer_id"),
    )


def tick_message(tick: Column, key: Column) -> list[Column]:
    """Keyed message columns (``key`` = ticker, ``value`` = JSON text)."""
    return [key.alias("key"), F.to_json(tick).alias("value")]


def parse_tick(raw: Column) -> Column:
    """Typed struct parsed from JSON text (PERMISSIVE: bad fields become null)."""
    return F.from_json(raw, TICK)


def _field(payload: Column, field: str) -> Column:
    return F.variant_get(payload, f"$.{field}", "variant")


def _reason_from_parts(
    is_object: Column,
    fields: dict[str, Column],
    types: dict[str, Column],
    ticker: Column,
    price: Column,
    volume: Column,
    time_ok: Column,
    source: Column,
) -> Column:
    """First failing rule, from already-extracted parts (cheap column logic)."""
    # concat_ws skips nulls: the absent names, in field order, without a lambda
    absent = [fields[name].isNull() for name in REQUIRED_TICK_FIELDS]
    missing_list = F.concat_ws(
        ", ", *[F.when(a, F.lit(name)) for a, name in zip(absent, REQUIRED_TICK_FIELDS)]
    )
    any_missing = absent[0]
    for a in absent[1:]:
        any_missing = any_missing | a
    return (
        F.when(~F.coalesce(is_object, F.lit(False)), F.lit(NOT_AN_OBJECT))
        .when(any_missing, F.concat(F.lit(TICK_REASONS["missing_prefix"]), missing_list))
        .when((types["ticker"] != "STRING") | (F.trim(ticker) == ""), F.lit(TICK_REASONS["ticker"]))
        .when(~_is_number(types["price"], price), F.lit(TICK_REASONS["price_type"]))
        .when(price <= 0, F.lit(TICK_REASONS["price_sign"]))
        .when(~_is_integer(types["volume"]) | volume.isNull(), F.lit(TICK_REASONS["volume_type"]))
        .when(volume < 0, F.lit(TICK_REASONS["volume_sign"]))
        .when((types["event_time"] != "STRING") | ~time_ok, F.lit(TICK_REASONS["time"]))
        .when((types["source"] != "STRING") | ~source.isin(*VALID_SOURCES), F.lit(TICK_REASONS["source"]))
        .otherwise(F.lit(TICK_REASONS["ok"]))
    )


def reject_reason(raw: Column) -> Column:
    """Reason text for one raw message; the first failing rule wins.

    Single-expression form (handy in filters and tests). On large inputs use
    ``with_tick_check``, which parses each message once.
    """
    payload = F.try_parse_json(raw)
    fields = {name: _field(payload, name) for name in REQUIRED_TICK_FIELDS}
    return _reason_from_parts(
        _is_object(raw, payload),
        fields,
        {name: F.schema_of_variant(fields[name]) for name in TYPED_FIELDS},
        F.try_variant_get(fields["ticker"], "$", "string"),
        F.try_variant_get(fields["price"], "$", "double"),
        F.try_variant_get(fields["volume"], "$", "bigint"),
        iso_string_to_ntz(F.try_variant_get(fields["event_time"], "$", "string")).isNotNull(),
        F.try_variant_get(fields["source"], "$", "string"),
    )


def is_valid(raw: Column) -> Column:
    """Never null: a message that cannot be judged goes to the dead letters."""
    return F.coalesce(reject_reason(raw) == F.lit(TICK_REASONS["ok"]), F.lit(False))


def with_tick_check(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``reason`` plus typed fields ``t_ticker, t_price, t_volume, t_event_time``.

    Staged projections: the JSON is parsed once into a VARIANT, each field is taken
    out of it once, token types and values are read from the fields, and the reason is
    plain column logic. (A single expression would re-parse inside every conditional
    branch.) The stage's generated code has to stay under the 8,000 bytes that the JVM
    compiles (``tests/test_plans.py``): beyond them it is interpreted, at a third of the pace.
    """
    parsed = df.withColumn("_v", F.try_parse_json(F.col(raw)))
    split = parsed.select(
        *df.columns,
        _is_object(F.col(raw), F.col("_v")).alias("_obj"),
        *[_field(F.col("_v"), n).alias(f"_f_{n}") for n in REQUIRED_TICK_FIELDS],
    )
    parts = split.select(
        "*",
        *[F.schema_of_variant(f"_f_{n}").alias(f"_ty_{n}") for n in TYPED_FIELDS],
        F.try_variant_get("_f_ticker", "$", "string").alias("t_ticker_raw"),
        F.try_variant_get("_f_price", "$", "double").alias("t_price"),
        F.try_variant_get("_f_volume", "$", "bigint").alias("t_volume"),
        F.try_variant_get("_f_event_time", "$", "string").alias("_time_text"),
        F.try_variant_get("_f_source", "$", "string").alias("_source"),
    )
    timed = parts.withColumn("t_event_time", iso_string_to_ntz(F.col("_time_text")))
    reason = _reason_from_parts(
        F.col("_obj"),
        {n: F.col(f"_f_{n}") for n in REQUIRED_TICK_FIELDS},
        {n: F.col(f"_ty_{n}") for n in TYPED_FIELDS},
        F.col("t_ticker_raw"),
        F.col("t_price"),
        F.col("t_volume"),
        F.col("t_event_time").isNotNull(),
        F.col("_source"),
    )
    # Emit the results through a one-row generator: a later filter on ``reason``
    # cannot be pushed below a Generate, so it cannot re-inline the whole check
    # into a single un-shared expression under the scan.
    result = F.struct(
        reason.alias("reason"),
        F.upper(F.trim(F.col("t_ticker_raw"))).alias("t_ticker"),
        F.col("t_price").alias("t_price"),
        F.col("t_volume").alias("t_volume"),
        F.col("t_event_time").alias("t_event_time"),
    )
    return timed.select(*df.columns, F.inline(F.array(result)))
