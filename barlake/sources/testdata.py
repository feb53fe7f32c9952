"""Adapters from the driver's test tables to the market-data domain.

The reference downloads prices and replays them as ticks; here the same shapes
are derived from the given tables by fixed rules, so every query reads real
tables and its work grows with them:

* ticks        <- ``events``: ticker = upper(event_type), price = value,
                  volume = props.k, event_time = ts.
* price feed   <- ``orders`` joined with ``customer``: one raw daily-price row
                  per order, ``seq`` = o_orderkey gives the arrival order.
* companies    <- ``customer`` + ``nation`` + ``region``.
* audit runs   <- ``orders`` grouped by order date.

The DuckDB oracles in ``barlake.plans.oracle`` repeat these rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.ticks import build_tick
from barlake.functions.timecols import iso_text
from barlake.schemas import STATUS_FAILED, STATUS_SUCCESS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# Ticks
# ---------------------------------------------------------------------------


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean ticks: event_id, ticker, price, volume, event_time (naive UTC)."""
    return read_table(spark, sf_dir, "events").select(
        "event_id",
        F.upper(F.col("event_type")).alias("ticker"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("volume"),
        F.col("ts").alias("event_time"),
    )


# Injected faults, chosen by a rule on event_id so the oracle can repeat them.
# Every message still goes through the query; none is dropped.
FAULT_MODULUS = 40
FAULT_KINDS = {
    0: "negative price",
    1: "no source field",
    2: "time 'yesterday'",
    3: "source 'manual'",
    4: "blank ticker",
    5: "price as text",
    6: "negative volume",
    7: "not JSON",
    8: "no producer_id field",
    9: "fractional volume",
}


def tick_messages(spark: SparkSession, sf_dir: str, with_faults: bool = True) -> DataFrame:
    """Keyed JSON tick messages built from events: event_id, key, value.

    With ``with_faults`` a fixed share of messages is broken on purpose (see
    ``FAULT_KINDS``) to exercise validation and the dead-letter split.
    """
    ev = read_table(spark, sf_dir, "events")
    ticker = F.col("event_type")
    price = F.col("value")
    volume = F.get_json_object("props", "$.k").try_cast("bigint")
    good = build_tick(ticker, price, volume, F.col("ts"), F.lit("events"))
    value: Column = F.to_json(good)
    if with_faults:
        kind = F.col("event_id") % FAULT_MODULUS

        def message(price: Column, volume: Column) -> Column:
            # to_json leaves null fields out: kinds 1 and 8 lack a field
            return F.to_json(F.struct(
                F.when(kind == 4, "   ").otherwise(F.upper(F.trim(ticker))).alias("ticker"),
                price.alias("price"),
                volume.alias("volume"),
                F.when(kind == 2, "yesterday").otherwise(iso_text(F.col("ts"))).alias("event_time"),
                F.when(kind == 3, "manual").when(kind != 1, "replay").alias("source"),
                F.when(kind != 8, "events").alias("producer_id"),
            ))

        value = (
            F.when(kind == 5, message(F.lit("abc"), volume))
            .when(kind == 7, F.lit("not json"))
            .when(kind == 9, message(price, volume.cast("double") + F.lit(0.5)))
            .otherwise(message(
                F.when(kind == 0, -price).otherwise(price),
                F.when(kind == 6, -volume - 1).otherwise(volume),
            ))
        )
    return ev.select("event_id", F.upper(F.trim(ticker)).alias("key"), value.alias("value"))


# ---------------------------------------------------------------------------
# Daily price feed
# ---------------------------------------------------------------------------


def feed_ticker(segment: Column, nationkey: Column, acctbal: Column) -> Column:
    """Five segment tickers; customers in debt get a malformed ticker (letters + digits)."""
    return F.when(
        acctbal < 0, F.concat(F.upper(F.substring(segment, 1, 3)), nationkey.cast("string"))
    ).otherwise(F.upper(F.substring(segment, 1, 5)))


def price_feed(spark: SparkSession, sf_dir: str, many_keys: bool = False) -> DataFrame:
    """Raw flat extract: Date, Ticker, Open, High, Low, Close, Adj Close, Volume, seq.

    Urgent orders get a low above the close, which the price-relationship check
    must flag. ``seq`` (the order key) is unique and orders duplicates. With
    ``many_keys`` every customer is its own ticker (``C<custkey>``), so the
    number of tickers grows with the data instead of five hot ones.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    close = F.col("o_totalprice") / F.lit(100.0)
    open_ = close * (F.lit(0.98) + F.lit(0.01) * (F.col("o_custkey") % 5))
    return joined.select(
        F.col("o_orderdate").alias("Date"),
        (
            F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
            if many_keys
            else feed_ticker(F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_acctbal"))
        ).alias("Ticker"),
        open_.alias("Open"),
        (F.greatest(open_, close) * F.lit(1.01)).alias("High"),
        F.when(F.col("o_orderpriority") == "1-URGENT", close * F.lit(1.005))
        .otherwise(F.least(open_, close) * F.lit(0.99))
        .alias("Low"),
        close.alias("Close"),
        (close * F.lit(0.98)).alias("Adj Close"),
        (F.col("o_custkey") * 100).alias("Volume"),
        F.col("o_orderkey").alias("seq"),
    )


def wide_price_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide layout (one row per date, ``<Field>_<Ticker>`` columns) for all tickers of
    the feed, the shape a multi-ticker download returns. The tickers are the
    columns, at most segments x (nations + 1), so they are looked up first."""
    from barlake.schemas import RAW_FIELDS

    feed = price_feed(spark, sf_dir)
    customer = read_table(spark, sf_dir, "customer").select(
        feed_ticker(F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_acctbal")).alias("ticker")
    )
    tickers = sorted(r[0] for r in customer.distinct().collect())
    aggs = [
        F.max_by(F.col(field), F.col("seq")).alias(field.replace(" ", "_")) for field in RAW_FIELDS
    ]
    wide = feed.groupBy("Date").pivot("Ticker", tickers).agg(*aggs)
    # pivot names columns <ticker>_<field>; rename to <field>_<ticker>
    renames = {}
    for t in tickers:
        for field in RAW_FIELDS:
            renames[f"{t}_{field.replace(' ', '_')}"] = f"{field}_{t}"
    return wide.withColumnsRenamed(renames)


def company_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company attributes per ticker: name from the segment, sector = region, industry = nation.

    One row per ticker: the customer with the smallest key decides. The
    provider knows nothing of the HOUSEHOLD segment, whose tickers get nulls.
    """
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    covered = F.col("c_mktsegment") != "HOUSEHOLD"
    rows = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, F.col("n_regionkey") == region.r_regionkey)
        .select(
            feed_ticker(F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_acctbal")).alias("ticker"),
            "c_custkey",
            F.when(covered, F.concat(F.initcap("c_mktsegment"), F.lit(" Holdings"))).alias("company_name"),
            F.when(covered, F.col("r_name")).alias("sector"),
            F.when(covered, F.col("n_name")).alias("industry"),
        )
    )
    best = rows.groupBy("ticker").agg(
        F.min_by(F.struct("company_name", "sector", "industry"), F.col("c_custkey")).alias("a")
    )
    return best.select("ticker", "a.company_name", "a.sector", "a.industry")


def requested_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw request strings, one per customer, as a user would type them:
    lower case, padded, with an empty item (``" mac7 , ,MAC7"``)."""
    customer = read_table(spark, sf_dir, "customer")
    t = feed_ticker(F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_acctbal"))
    return customer.select(F.concat(F.lit(" "), F.lower(t), F.lit(" , ,"), t).alias("request"))


def pipeline_runs_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One audit row per order date; a day with a pending order counts as a failed run."""
    orders = read_table(spark, sf_dir, "orders")
    per_day = orders.groupBy("o_orderdate").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("o_orderstatus") == "P").alias("n_pending"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_done"),
        F.count_if(F.col("o_orderstatus") == "O").alias("n_open"),
    )
    started = F.timestamp_add("MINUTE", F.lit(22 * 60 + 30), F.col("o_orderdate"))
    failed = F.col("n_pending") > 0
    return per_day.select(
        F.date_format("o_orderdate", "yyyyMMdd").cast("bigint").alias("run_id"),
        F.concat(F.lit("run-"), F.date_format("o_orderdate", "yyyyMMdd")).alias("batch_id"),
        started.alias("started_at"),
        F.timestamp_add("SECOND", F.col("n"), started).alias("completed_at"),
        F.when(failed, F.lit(STATUS_FAILED)).otherwise(F.lit(STATUS_SUCCESS)).alias("status"),
        F.lit(None).cast("string").alias("tickers"),
        F.col("n").alias("rows_extracted"),
        F.when(failed, F.lit(0)).otherwise(F.col("n_done")).cast("bigint").alias("rows_inserted"),
        F.col("n_open").alias("rows_skipped"),
        (~failed).alias("quality_checks_passed"),
        F.when(failed, F.lit("Critical quality checks failed: null_tickers")).alias("error_message"),
    )
