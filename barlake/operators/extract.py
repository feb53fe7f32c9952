"""Incremental extract from a price source DataFrame.

The reference downloads each ticker over HTTP from its own start date. Here
the source is any DataFrame (or Parquet path) of raw rows; the per-ticker start
dates are a small table joined to it, so one scan serves all tickers, and a
constant lower bound (the earliest start) lets Parquet skip old row groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.schemas import LOOKBACK_DAYS, OVERLAP_DAYS


def normalise_requests(requests: DataFrame, col: str = "request") -> DataFrame:
    """Comma-separated ticker requests -> distinct tickers: trimmed, upper-cased,
    blanks dropped."""
    items = requests.select(F.explode(F.split(F.col(col), ",")).alias("raw"))
    t = F.upper(F.trim(F.col("raw")))
    return items.select(t.alias("ticker")).where(F.col("ticker") != "").distinct()


def require_tickers(tickers: DataFrame) -> None:
    if tickers.isEmpty():
        raise ValueError("the ticker request is empty after trimming blanks")


def start_dates(
    tickers: DataFrame,
    last_stored: DataFrame,
    today: Column,
    lookback_days: int = LOOKBACK_DAYS,
    overlap_days: int = OVERLAP_DAYS,
) -> DataFrame:
    """Per requested ticker: last stored date, window start and end.

    start = last stored - overlap days, else today - lookback days; end = today
    (exclusive). Both as DATE.
    """
    joined = tickers.select("ticker").join(last_stored, "ticker", "left")
    start = F.coalesce(
        F.date_sub(F.col("last_date"), overlap_days), F.date_sub(today.cast("date"), lookback_days)
    )
    return joined.select(
        "ticker",
        "last_date",
        start.alias("start_date"),
        today.cast("date").alias("end_date"),
    )


def incremental_extract(
    source: DataFrame,
    windows: DataFrame,
    ticker_col: str = "Ticker",
    date_col: str = "Date",
    bounds: tuple | None = None,
) -> DataFrame:
    """Rows of ``source`` whose date lies in their ticker's ``[start_date, end_date)``.

    ``windows`` has one row per requested ticker (see ``start_dates``); AQE
    broadcasts it when it measures it small and splits a hot ticker's
    partition otherwise. ``bounds`` = (earliest start, latest end) as literals
    lets the Parquet scan skip files and row groups outside every window.
    """
    if bounds is not None:
        lo, hi = bounds
        if lo is not None:
            source = source.where(F.col(date_col) >= F.lit(str(lo)).cast("timestamp_ntz"))
        if hi is not None:
            source = source.where(F.col(date_col) < F.lit(str(hi)).cast("timestamp_ntz"))
    w = windows.select(
        F.col("ticker").alias("_t"),
        F.col("start_date").cast("timestamp_ntz").alias("_s"),
        F.col("end_date").cast("timestamp_ntz").alias("_e"),
    )
    cond = (
        (F.col(ticker_col) == F.col("_t"))
        & (F.col(date_col) >= F.col("_s"))
        & (F.col(date_col) < F.col("_e"))
    )
    return source.join(w, cond, "inner").drop("_t", "_s", "_e")


def window_bounds(windows: DataFrame) -> tuple:
    """(earliest start, latest end) of the windows: one small aggregate."""
    row = windows.agg(F.min("start_date").alias("lo"), F.max("end_date").alias("hi")).first()
    return row["lo"], row["hi"]


def failed_tickers(requested: DataFrame, extract: DataFrame, ticker_col: str = "Ticker") -> DataFrame:
    """Requested tickers that returned no rows (reported, not fatal)."""
    got = extract.select(F.col(ticker_col).alias("ticker")).distinct()
    return requested.select("ticker").join(got, "ticker", "left_anti")


def require_rows(extract: DataFrame) -> None:
    if extract.isEmpty():
        raise ValueError("the extract returned no rows for any requested ticker")


def company_info(tickers: DataFrame, attributes: DataFrame) -> DataFrame:
    """Tickers with name, sector, industry; nulls where the provider has nothing."""
    return (
        tickers.select("ticker")
        .where(F.col("ticker").isNotNull())
        .distinct()
        .join(attributes.select("ticker", "company_name", "sector", "industry"), "ticker", "left")
    )


def union_extracts(*parts: DataFrame) -> DataFrame:
    """Union by column name; a column missing from a part is null there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
