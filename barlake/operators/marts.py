"""Report measures over the star schema (the BI layer of the reference).

Fact -> dim_company is a many-to-one join on company_id (the dimension grows
with the number of tickers, so no broadcast hint: AQE broadcasts it when it
measures it small). Fact -> dim_date joins the calendar, whose size is fixed
by its date range, so it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.prices import exact_mean
from barlake.schemas import (
    HEALTH_RECENT_MINUTES,
    MONTH_NAMES,
    RETURN_BIN_WIDTH,
    RETURN_LOOKBACK_DAYS,
    STATUS_SUCCESS,
)

ALL_TICKERS = "(all)"


def star(fact: DataFrame, dim_company: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact rows with company and calendar attributes."""
    comp = dim_company.select("company_id", "company_name", "sector", "industry")
    cal = dim_date.select("date_id", "full_date", "year", "quarter", "month", "month_name")
    return fact.join(comp, "company_id", "left").join(F.broadcast(cal), "date_id", "left")


def with_calendar(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact rows with calendar attributes only (for measures that need no company)."""
    cal = dim_date.select("date_id", "full_date", "year", "quarter", "month", "month_name")
    return fact.join(F.broadcast(cal), "date_id", "left")


def slice_star(starred: DataFrame, company_name: str | None = None, year: int | None = None) -> DataFrame:
    """Page slicers: company name and calendar year (None = no filter)."""
    out = starred
    if company_name is not None:
        out = out.where(F.col("company_name") == company_name)
    if year is not None:
        out = out.where(F.col("year") == year)
    return out


def latest_close(fact: DataFrame) -> DataFrame:
    """Average close on the latest date: per ticker, plus one overall row
    (ticker = '(all)') for the latest date over all tickers.

    One scan: grouping sets give the means of each (ticker, day) and of each day over
    all tickers, partial sums first; the latest day of each is a second hash aggregate
    over those means, so no task holds a ticker's rows.
    """
    f = fact.select("ticker", "price_date", "close_price").where(F.col("price_date").isNotNull())
    by_day = f.groupingSets([["ticker", "price_date"], ["price_date"]], "ticker", "price_date").agg(
        F.grouping("ticker").alias("_all"), exact_mean(F.col("close_price")).alias("mean")
    )
    latest = by_day.groupBy("_all", "ticker").agg(
        F.max("price_date").alias("price_date"), F.max_by("mean", "price_date").alias("latest_close")
    )
    return latest.select(
        F.when(F.col("_all") == 1, F.lit(ALL_TICKERS)).otherwise(F.col("ticker")).alias("ticker"),
        "price_date",
        "latest_close",
    )


def return_30d(fact: DataFrame, days: int = RETURN_LOOKBACK_DAYS) -> DataFrame:
    """Per ticker: latest close vs the close on the last available date at least
    ``days`` before the latest one; (latest - prior) / prior, null when undefined.

    One shuffle on ticker: the latest and prior dates are window values over the
    ticker (bounded by the calendar) and the final grouping reuses the partitioning.
    """
    f = fact.select("ticker", "price_date", "close_price")
    by_ticker = Window.partitionBy("ticker")
    latest = F.max("price_date").over(by_ticker)
    with_latest = f.withColumn("latest_date", latest)
    cutoff = F.date_sub(F.col("latest_date"), days).cast("timestamp_ntz")
    with_prior = with_latest.withColumn(
        "prior_date", F.max(F.when(F.col("price_date") <= cutoff, F.col("price_date"))).over(by_ticker)
    )
    out = with_prior.groupBy("ticker", "latest_date", "prior_date").agg(
        exact_mean(F.when(F.col("price_date") == F.col("latest_date"), F.col("close_price"))).alias(
            "latest_close"
        ),
        exact_mean(F.when(F.col("price_date") == F.col("prior_date"), F.col("close_price"))).alias(
            "prior_close"
        ),
    )
    return out.select(
        "ticker",
        "latest_date",
        "latest_close",
        "prior_date",
        "prior_close",
        F.try_divide(F.col("latest_close") - F.col("prior_close"), F.col("prior_close")).alias(
            "return_30d"
        ),
    )


def load_success_rate(runs: DataFrame) -> DataFrame:
    """SUCCESS runs / all runs (null when there are no runs)."""
    return runs.agg(
        F.count("*").alias("runs"),
        F.count_if(F.col("status") == STATUS_SUCCESS).alias("successful"),
        F.try_divide(
            F.count_if(F.col("status") == STATUS_SUCCESS).cast("double"), F.count("*").cast("double")
        ).alias("success_rate"),
    )


def price_trend(starred: DataFrame) -> DataFrame:
    """Average close per calendar day and company."""
    return starred.groupBy("full_date", "company_name").agg(
        exact_mean(F.col("close_price")).alias("avg_close")
    )


def return_histogram(fact: DataFrame, bin_width: float = RETURN_BIN_WIDTH) -> DataFrame:
    """Daily-return counts per ticker in bins of ``bin_width`` (integer bin index;
    bin k covers [k * width, (k + 1) * width))."""
    r = fact.where(F.col("daily_return").isNotNull())
    b = F.floor(F.col("daily_return") / F.lit(float(bin_width))).alias("bin")
    return r.groupBy("ticker", b).agg(F.count("*").alias("days"))


def volume_matrix(dated: DataFrame) -> DataFrame:
    """Ticker x month-name matrix of summed volume (months in calendar order).

    Needs only the calendar (``with_calendar``); the pivot values are fixed, so
    no extra job looks them up."""
    return dated.groupBy("ticker").pivot("month_name", MONTH_NAMES).agg(F.sum("volume"))


def latest_facts(fact: DataFrame, n: int = 10) -> DataFrame:
    """The newest ``n`` fact rows (ties broken by ticker)."""
    return fact.orderBy(F.col("price_date").desc(), F.col("ticker").asc()).limit(n)


def run_health(runs: DataFrame) -> DataFrame:
    """Pipeline-run table, newest first."""
    return runs.select("started_at", "status", "rows_inserted", "error_message").orderBy(
        F.col("started_at").desc()
    )


def stream_health(bars: DataFrame, alerts: DataFrame, now, recent_minutes: int = HEALTH_RECENT_MINUTES) -> DataFrame:
    """Bars in total, bars processed in the last minutes, alerts, latest processed_at."""
    cutoff = F.timestamp_add("MINUTE", F.lit(-recent_minutes), now)
    b = bars.agg(
        F.count("*").alias("total_bars"),
        F.count_if(F.col("processed_at") >= cutoff).alias("bars_last_5min"),
        F.max("processed_at").alias("latest_processed_at"),
    )
    return b.select("*", alerts.agg(F.count("*")).scalar().alias("total_alerts"))
