"""The nine data-quality checks and their runner.

All checks come out of one pass: per-row flags are summed per (ticker, day)
on the map side (the key's row count is also the duplicate check), windows
per ticker and month over those keyed rows find the date gaps, and one global
aggregate totals everything. Only the five ticker examples take a second,
top-k pass. The result is a small tall table
``(check, severity, passed, failures, details)``; only that table is ever
brought to the driver.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from barlake.functions.prices import nan_to_null
from barlake.operators.windows import previous_in_key
from barlake.schemas import (
    CHECK_ORDER,
    CRITICAL_CHECKS,
    CRITICAL_ERROR_PREFIX,
    DATE_GAP_DAYS,
    FRACTIONAL_VOLUME_ISSUE,
    PRICE_COLUMNS,
    TICKER_EXAMPLES,
    TICKER_PATTERN,
)

REQUIRED = ("ticker", "price_date", "volume", *PRICE_COLUMNS)


class CriticalQualityError(ValueError):
    """Raised when a critical check fails; carries the failed check names."""

    def __init__(self, failed: list[str]):
        self.failed = failed
        super().__init__(
            f"{CRITICAL_ERROR_PREFIX}{', '.join(failed)}. The run stops here; the quality "
            "report has the counts."
        )


def require_columns(df: DataFrame) -> None:
    missing = sorted(set(REQUIRED).difference(df.columns))
    if missing:
        raise ValueError(f"quality checks need columns that are absent: {', '.join(missing)}")


def _volume_is_fractional_type(df: DataFrame) -> bool:
    return isinstance(df.schema["volume"].dataType, (DoubleType, FloatType, DecimalType))


def duplicate_groups(df: DataFrame, keys=("ticker", "price_date")) -> DataFrame:
    """Keys that occur more than once, with their number of copies."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def invalid_ticker_examples(df: DataFrame, n: int = TICKER_EXAMPLES) -> DataFrame:
    """The first ``n`` distinct malformed tickers in sort order (a top-n, not a collect)."""
    bad = df.where(F.col("ticker").isNotNull() & ~F.col("ticker").rlike(TICKER_PATTERN))
    return bad.select("ticker").distinct().orderBy("ticker").limit(n)


def date_gaps(df: DataFrame, max_gap_days: int = DATE_GAP_DAYS) -> DataFrame:
    """One row per gap of more than ``max_gap_days`` whole days between consecutive
    dates of a ticker: ticker, gap_after (the earlier date), gap_calendar_days."""
    # distinct times first: a duplicate is never a gap
    dated = (
        df.where(F.col("ticker").isNotNull() & F.col("price_date").isNotNull())
        .select("ticker", "price_date")
        .distinct()
    )
    lagged = previous_in_key(dated, ["ticker"], "price_date", [], prefix="_p_")
    days = F.timestamp_diff("DAY", F.col("_p_price_date"), F.col("price_date"))
    return lagged.select(
        "ticker",
        F.col("_p_price_date").alias("gap_after"),
        days.alias("gap_calendar_days"),
    ).where(F.col("gap_calendar_days") > max_gap_days)


def _severity(name: str) -> Column:
    return F.lit("CRITICAL" if name in CRITICAL_CHECKS else "WARNING")


def _row_flags(df: DataFrame) -> list[Column]:
    """Per-row 0/1 failure flags of the counter checks."""
    p = {c: nan_to_null(F.col(c).cast("double")) for c in PRICE_COLUMNS}
    ticker = F.col("ticker")

    def flag(cond: Column) -> Column:
        return F.coalesce(cond, F.lit(False)).cast("long")

    rel = (
        F.coalesce(p["low_price"] > p["open_price"], F.lit(False))
        | F.coalesce(p["low_price"] > p["close_price"], F.lit(False))
        | F.coalesce(p["open_price"] > p["high_price"], F.lit(False))
        | F.coalesce(p["close_price"] > p["high_price"], F.lit(False))
    )
    if _volume_is_fractional_type(df):
        v = nan_to_null(F.col("volume").cast("double"))
        fractional = flag(v != F.floor(v))
    else:
        fractional = F.lit(0).cast("long")
    return [
        (flag(ticker.isNull()) + flag(ticker.rlike(r"^\s*$"))).alias("null_tickers"),
        flag(F.col("price_date").isNull()).alias("null_dates"),
        *[flag(p[c] < 0).alias(f"neg_{c}") for c in PRICE_COLUMNS],
        flag(nan_to_null(F.col("volume").cast("double")) < 0).alias("negative_volume"),
        flag(rel).alias("price_relationships"),
        flag(ticker.isNotNull() & ~ticker.rlike(TICKER_PATTERN)).alias("invalid_ticker_format"),
        fractional.alias("fractional_volume"),
    ]


_COUNTERS = [
    "null_tickers",
    "null_dates",
    *[f"neg_{c}" for c in PRICE_COLUMNS],
    "negative_volume",
    "price_relationships",
    "invalid_ticker_format",
    "fractional_volume",
]


def check_totals(df: DataFrame, max_gap_days: int = DATE_GAP_DAYS) -> DataFrame:
    """One row with every counter, the duplicate rows and the date gaps.

    One shuffle on (ticker, day): each key's counters are summed map-side, and
    the key's row count is the duplicate check. The previous date of each key is
    found by month, with the months' edges carried over, which finds the gaps.
    """
    flagged = df.select("ticker", "price_date", *_row_flags(df))
    keyed = flagged.groupBy("ticker", "price_date").agg(
        F.count("*").alias("_n"), *[F.sum(c).alias(c) for c in _COUNTERS]
    )
    prev = previous_in_key(keyed, ["ticker"], "price_date", [], prefix="_p_")
    days = F.timestamp_diff("DAY", F.col("_p_price_date"), F.col("price_date"))
    gap = F.col("ticker").isNotNull() & F.col("price_date").isNotNull() & (days > max_gap_days)
    return prev.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTERS],
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("duplicate_rows"),
        F.count_if(F.coalesce(gap, F.lit(False))).alias("date_gaps"),
    )


def quality_results(df: DataFrame) -> DataFrame:
    """Tall result of all nine checks: check, severity, passed, failures, details.

    ``details`` is JSON text: failing price columns, ticker examples, or the
    issue text of the column-type check. Gap rows are their own table
    (``date_gaps``); here they are counted.
    """
    require_columns(df)
    neg_cols = F.filter(
        F.array(*[F.when(F.col(f"neg_{p}") > 0, F.lit(p)) for p in PRICE_COLUMNS]),
        lambda x: x.isNotNull(),
    )
    neg_total = sum((F.col(f"neg_{p}") for p in PRICE_COLUMNS), F.lit(0))
    issue = F.lit(FRACTIONAL_VOLUME_ISSUE)

    def row(name, failures, passed=None, details=None):
        return F.struct(
            F.lit(name).alias("check"),
            _severity(name).alias("severity"),
            (passed if passed is not None else failures == 0).alias("passed"),
            failures.cast("bigint").alias("failures"),
            (details if details is not None else F.lit(None).cast("string")).alias("details"),
        )

    # at most TICKER_EXAMPLES rows, attached as a scalar subquery (no join)
    examples = invalid_ticker_examples(df).agg(F.collect_list("ticker").alias("examples"))
    totals = check_totals(df).select("*", examples.scalar().alias("examples"))
    tall = totals.select(
        F.inline(
            F.array(
                row("null_tickers", F.col("null_tickers")),
                row("null_dates", F.col("null_dates")),
                row(
                    "negative_prices",
                    neg_total,
                    F.size(neg_cols) == 0,
                    F.when(F.size(neg_cols) > 0, F.to_json(F.struct(neg_cols.alias("columns")))),
                ),
                row("negative_volume", F.col("negative_volume")),
                row("duplicate_rows", F.col("duplicate_rows")),
                row("price_relationships", F.col("price_relationships")),
                row(
                    "invalid_ticker_format",
                    F.col("invalid_ticker_format"),
                    None,
                    F.when(
                        F.col("invalid_ticker_format") > 0,
                        F.to_json(F.struct(F.array_sort("examples").alias("examples"))),
                    ),
                ),
                row("date_gaps", F.col("date_gaps")),
                row(
                    "column_types",
                    (F.col("fractional_volume") > 0).cast("int"),
                    None,
                    F.when(
                        F.col("fractional_volume") > 0,
                        F.to_json(F.struct(F.array(issue).alias("issues"))),
                    ),
                ),
            )
        )
    )
    return tall


def summarize(results_rows) -> dict:
    """Driver-side view of the (nine-row) result: per-check dicts and the verdict."""
    checks = {}
    for r in results_rows:
        entry = {"passed": bool(r["passed"]), "failures": int(r["failures"])}
        if r["details"]:
            entry.update(json.loads(r["details"]))
        checks[r["check"]] = entry
    failed = [n for n in CHECK_ORDER if n in checks and not checks[n]["passed"]]
    critical = [n for n in failed if n in CRITICAL_CHECKS]
    return {"checks": checks, "overall_passed": not failed, "failed": failed, "critical": critical}


def run_quality_checks(df: DataFrame, raise_on_critical: bool = True) -> dict:
    """Run all checks; raise ``CriticalQualityError`` when a critical one fails."""
    summary = summarize(quality_results(df).collect())
    if raise_on_critical and summary["critical"]:
        raise CriticalQualityError(summary["critical"])
    return summary
