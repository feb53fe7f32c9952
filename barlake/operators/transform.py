"""Raw price extract -> analytics-ready daily prices (the batch transform).

Steps, in the reference order: trim column names, find the date column,
rename to canonical names, check required columns, project, coerce types,
keep the last row per (ticker, day), compute the daily return, stamp the
load time. Bad dates and numbers become null instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    TimestampNTZType,
    TimestampType,
)

from barlake.functions.prices import nan_to_null, simple_return
from barlake.functions.timecols import as_ntz
from barlake.operators.windows import previous_in_key
from barlake.schemas import (
    DATE_COLUMN_NAMES,
    OUTPUT_COLUMNS,
    PRICE_COLUMNS,
    RAW_FIELDS,
    RAW_RENAMES,
    REQUIRED_COLUMNS,
)

KEYS = ("ticker", "price_date")


def find_date_column(columns: Sequence[str]) -> str:
    """First column named date/datetime/price_date, any case."""
    for name in columns:
        if name.lower() in DATE_COLUMN_NAMES:
            return name
    raise ValueError("no date column (date, datetime or price_date) in the extract")


def missing_columns(columns: Sequence[str], required: Sequence[str]) -> list[str]:
    return sorted(set(required).difference(columns))


def standardize_columns(raw: DataFrame, keep: Sequence[str] = ("seq",)) -> DataFrame:
    """Trim names, rename to canonical names, check and project the required columns.

    Columns listed in ``keep`` (such as an arrival sequence) ride along when present.
    """
    trimmed = raw.toDF(*[str(c).strip() for c in raw.columns])
    if "Ticker" not in trimmed.columns and "ticker" not in trimmed.columns:
        raise ValueError("a flat extract needs a Ticker column; tag single-ticker extracts with tag_ticker()")
    date_col = find_date_column(trimmed.columns)
    renames = {k: v for k, v in RAW_RENAMES.items() if k in trimmed.columns}
    renames[date_col] = "price_date"
    renamed = trimmed.withColumnsRenamed(renames)
    missing = missing_columns(renamed.columns, REQUIRED_COLUMNS)
    if missing:
        raise ValueError(f"the extract lacks required columns: {', '.join(missing)}")
    extra = [c for c in keep if c in renamed.columns and c not in REQUIRED_COLUMNS]
    return renamed.select(*REQUIRED_COLUMNS, *extra)


_INTEGRAL = (IntegerType, LongType, ShortType)


def _numeric(col: Column, dtype) -> Column:
    if isinstance(dtype, (DoubleType, FloatType, DecimalType)):
        return nan_to_null(col.cast("double"))
    if isinstance(dtype, _INTEGRAL):
        return col.cast("double")
    return nan_to_null(col.try_cast("double"))


def coerce_types(df: DataFrame) -> DataFrame:
    """Upper-case tickers (null kept, no trim), naive-UTC dates, numeric prices.

    ``volume`` stays an integer when it arrives as one; otherwise it becomes a
    double, so the column-type check can still see fractional volumes.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for name in df.columns:
        if name == "ticker":
            cols.append(F.upper(F.col(name).cast("string")).alias(name))
        elif name == "price_date":
            cols.append(as_ntz(F.col(name), types[name]).alias(name))
        elif name in PRICE_COLUMNS:
            cols.append(_numeric(F.col(name), types[name]).alias(name))
        elif name == "volume":
            if isinstance(types[name], _INTEGRAL):
                cols.append(F.col(name).cast("bigint").alias(name))
            else:
                cols.append(_numeric(F.col(name), types[name]).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def _split_wide_name(name: str, fields: Sequence[str]) -> tuple[str, str] | None:
    """``Close_AAPL`` or ``AAPL_Close`` -> (field, ticker); None when not a field column."""
    for field in fields:
        for spelled in {field, field.replace(" ", "_")}:
            if name.startswith(spelled + "_"):
                return field, name[len(spelled) + 1 :]
            if name.endswith("_" + spelled):
                return field, name[: -len(spelled) - 1]
    return None


def wide_to_long(wide: DataFrame, date_col: str = "Date") -> DataFrame:
    """Wide frame (one row per date, one column per field and ticker, either name
    order) -> long frame with a ``Ticker`` column. One pass, no shuffle."""
    by_ticker: dict[str, dict[str, str]] = {}
    for name in wide.columns:
        if name == date_col:
            continue
        split = _split_wide_name(name, RAW_FIELDS)
        if split:
            field, ticker = split
            by_ticker.setdefault(ticker, {})[field] = name
    if not by_ticker:
        raise ValueError("No <field>_<ticker> columns found in the wide frame")
    structs = []
    for ticker in sorted(by_ticker):
        cols = by_ticker[ticker]
        structs.append(
            F.struct(
                F.lit(ticker).alias("Ticker"),
                *[
                    (F.col(f"`{cols[f]}`") if f in cols else F.lit(None).cast("double")).alias(f)
                    for f in RAW_FIELDS
                ],
            )
        )
    return wide.select(F.col(date_col), F.inline(F.array(*structs)))


def tag_ticker(raw: DataFrame, ticker: str) -> DataFrame:
    """Single-ticker extract -> flat frame with a constant Ticker column."""
    return raw.withColumn("Ticker", F.lit(ticker))


# types an aggregation buffer can hold in place (hash aggregation)
_FIXED_WIDTH = (
    BooleanType, ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType,
    DateType, TimestampType, TimestampNTZType,
)


def _fixed_width(dtype) -> bool:
    return isinstance(dtype, _FIXED_WIDTH) or (isinstance(dtype, DecimalType) and dtype.precision <= 18)


def dedupe_last(df: DataFrame, seq_col: str = "seq", keys: Sequence[str] = KEYS) -> DataFrame:
    """Keep the last row per key, "last" = highest ``seq_col`` (arrival order,
    unique per key). Without an arrival column, file order stands in for it.

    An aggregate, not a window: duplicates of a hot key collapse map-side before
    the shuffle. With fixed-width columns each column is ``max_by(col, seq)``,
    which runs as a hash aggregate (about twice as fast as a struct payload,
    which needs a sort-based one); since ``seq`` is unique per key, every column
    comes from the same row.
    """
    keys = list(keys)
    if seq_col not in df.columns:
        df = df.withColumn(seq_col, F.monotonically_increasing_id())
    others = [c for c in df.columns if c not in keys]
    types = {f.name: f.dataType for f in df.schema.fields}
    seq = F.col(seq_col)
    if all(_fixed_width(types[c]) for c in others):
        aggs = [
            (F.max(seq) if c == seq_col else F.max_by(F.col(c), seq)).alias(c) for c in others
        ]
        return df.groupBy(*keys).agg(*aggs).select(*df.columns)
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*others), seq).alias("_r"))
    return last.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*df.columns)


def with_daily_return(df: DataFrame) -> DataFrame:
    """close / previous close - 1 per ticker in date order; null on a ticker's first
    row, across a missing close, and for rows without ticker or date.

    Expects one row per (ticker, time) (``dedupe_last`` first). A ticker with many
    times a day is spread over tasks by month (see ``previous_in_key``).
    """
    lagged = previous_in_key(df, ["ticker"], "price_date", ["close_price"], prefix="_p_")
    ret = simple_return(F.col("close_price"), F.col("_p_close_price"))
    keyed = F.col("ticker").isNotNull() & F.col("price_date").isNotNull()
    return lagged.withColumn(
        "daily_return", F.when(keyed, ret).otherwise(F.lit(None).cast("double"))
    ).drop("_p_price_date", "_p_close_price")


def transform_prices(raw: DataFrame, loaded_at: Column | None = None, seq_col: str = "seq") -> DataFrame:
    """Raw flat extract -> the 10 output columns (``seq_col`` kept when present)."""
    std = coerce_types(standardize_columns(raw, keep=(seq_col,)))
    deduped = dedupe_last(std, seq_col)
    with_ret = with_daily_return(deduped)
    stamp = loaded_at if loaded_at is not None else F.localtimestamp()
    out = with_ret.withColumn("loaded_at", stamp.cast("timestamp_ntz"))
    extra = [seq_col] if seq_col in raw.columns else []
    return out.select(*OUTPUT_COLUMNS, *extra)


def raw_as_text(raw: DataFrame) -> DataFrame:
    """Every column as text: the shape of an untyped extract (used by tests and
    the coercion query)."""
    return raw.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns])
