"""Registered queries: one per operator family of the survey, each with a DuckDB oracle.

Every query reads the given tables (``sf_dir``) over their whole extent and
returns a DataFrame; nothing is collected. Doubles computed by arithmetic are
not rounded: means are exact decimal sums over counts (``prices.exact_mean``), and
everything else is the same IEEE arithmetic on the same inputs in both engines,
so the doubles agree bit for bit. Timestamps stay ``TIMESTAMP_NTZ`` (DuckDB ``TIMESTAMP``),
and every time conversion is zone-free, so the queries leave the caller's session
settings alone and give the same rows in any session time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators import bars as bars_ops
from barlake.plans import oracle as O
from barlake.sources import testdata as src

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return deco


# ---------------------------------------------------------------------------
# Bars, reference average, alerts
# ---------------------------------------------------------------------------


def _bars(spark, sf_dir, width="1 minute"):
    ticks = src.event_ticks(spark, sf_dir)
    return bars_ops.ohlcv_bars(ticks, width)


@register(
    "intraday_bars",
    O.with_ctes(O.TICKS, O.bars_cte("1 minute", "minute")) + "SELECT * FROM bars",
)
def intraday_bars(spark, sf_dir):
    """1-minute OHLCV bars per ticker from event ticks."""
    return _bars(spark, sf_dir)


@register(
    "intraday_bars_1h",
    O.with_ctes(O.TICKS, O.bars_cte("1 hour", "hour")) + "SELECT * FROM bars",
)
def intraday_bars_1h(spark, sf_dir):
    """1-hour bars: same operator, wider window (the test events are sparse)."""
    return _bars(spark, sf_dir, "1 hour")


def _scored_sql(lookback: int) -> str:
    return O.with_ctes(O.TICKS, O.bars_cte("1 minute", "minute"), O.scored_cte(lookback)) + """
SELECT ticker, window_start, close,
       reference_avg,
       CASE WHEN reference_avg IS NULL THEN close ELSE (reference_avg + close) / 2.0 END
         AS avg_close_5min
FROM scored"""


def _scored(spark, sf_dir, lookback):
    scored = bars_ops.with_reference_average(_bars(spark, sf_dir), lookback)
    return scored.select(
        "ticker",
        "window_start",
        "close",
        "reference_avg",
        "avg_close_5min",
    )


@register("bar_reference_avg", _scored_sql(300))
def bar_reference_avg(spark, sf_dir):
    """Trailing 5-minute mean close of earlier bars, and avg_close_5min."""
    return _scored(spark, sf_dir, 300)


@register("bar_reference_avg_5h", _scored_sql(5 * 3600))
def bar_reference_avg_5h(spark, sf_dir):
    """Same with a 5-hour lookback, so most bars have a reference on sparse data."""
    return _scored(spark, sf_dir, 5 * 3600)


def _alerts_sql(lookback: int) -> str:
    return O.with_ctes(O.TICKS, O.bars_cte("1 minute", "minute"), O.scored_cte(lookback)) + f"""
SELECT ticker, window_start, close,
       reference_avg,
       {O.MOVE_PCT} AS move_pct,
       2.0::DOUBLE AS threshold_pct
FROM scored
WHERE reference_avg IS NOT NULL AND abs({O.MOVE_PCT}) > 2.0"""


def _alerts(spark, sf_dir, lookback):
    scored = bars_ops.with_reference_average(_bars(spark, sf_dir), lookback)
    alerts = bars_ops.price_alerts(scored, 2.0)
    return alerts.select(
        "ticker",
        "window_start",
        "close",
        "reference_avg",
        "move_pct",
        "threshold_pct",
    )


@register("price_alerts", _alerts_sql(300))
def price_alerts(spark, sf_dir):
    """Bars moving more than 2 % against the trailing 5-minute reference."""
    return _alerts(spark, sf_dir, 300)


@register("price_alerts_5h", _alerts_sql(5 * 3600))
def price_alerts_5h(spark, sf_dir):
    """Alerts against a 5-hour reference."""
    return _alerts(spark, sf_dir, 5 * 3600)


# ---------------------------------------------------------------------------
# Transform (P1-P16, W1, W2, U2): raw price feed -> daily prices
# ---------------------------------------------------------------------------

# Fixed run parameters of the registered queries (the oracles use the same).
RUN_TS = "2001-09-01 00:00:00"
AS_OF = "2001-09-01"
STORED_CUTOFF = "1998-01-01"
BATCH_ID = "batch-0001"


def _run_ts():
    return F.lit(RUN_TS).cast("timestamp_ntz")


def _clean(spark, sf_dir):
    from barlake.operators.transform import transform_prices

    return transform_prices(src.price_feed(spark, sf_dir), loaded_at=_run_ts())


CLEAN_COLS = (
    "ticker, price_date, open_price, high_price, low_price, close_price, adj_close_price, volume"
)


@register(
    "clean_prices",
    O.with_ctes(O.FEED, O.CLEAN)
    + f"SELECT {CLEAN_COLS}, daily_return, "
    f"TIMESTAMP '{RUN_TS}' AS loaded_at FROM clean",
)
def clean_prices(spark, sf_dir):
    """Full transform of the raw feed: the 10 output columns."""
    out = _clean(spark, sf_dir).drop("seq")
    return out


@register(
    "dedupe_last",
    O.with_ctes(O.FEED)
    + """SELECT "Ticker" AS ticker, "Date" AS price_date, arg_max("Close", seq) AS close_price,
       max(seq) AS seq, count(*) AS copies
FROM feed GROUP BY 1, 2""",
)
def dedupe_last(spark, sf_dir):
    """Keep-last per (ticker, day) by arrival order, with the number of copies seen."""
    from barlake.operators.transform import coerce_types, dedupe_last as dedupe, standardize_columns

    std = coerce_types(standardize_columns(src.price_feed(spark, sf_dir)))
    copies = std.groupBy("ticker", "price_date").agg(F.count("*").alias("copies"))
    kept = dedupe(std, "seq").select("ticker", "price_date", "close_price", "seq")
    return kept.join(copies, ["ticker", "price_date"])


@register(
    "daily_return",
    O.with_ctes(O.FEED, O.CLEAN)
    + "SELECT ticker, price_date, close_price, daily_return FROM clean",
)
def daily_return(spark, sf_dir):
    """close / previous close - 1 per ticker in date order."""
    return _clean(spark, sf_dir).select(
        "ticker", "price_date", "close_price", "daily_return"
    )


@register(
    "daily_return_many_keys",
    O.with_ctes(O.FEED_MANY_KEYS, O.CLEAN)
    + "SELECT ticker, price_date, close_price, daily_return FROM clean",
)
def daily_return_many_keys(spark, sf_dir):
    """Daily returns when every customer is its own ticker (tickers grow with the data)."""
    from barlake.operators.transform import transform_prices

    clean = transform_prices(src.price_feed(spark, sf_dir, many_keys=True), loaded_at=_run_ts())
    return clean.select("ticker", "price_date", "close_price", "daily_return")


def _text_feed(spark, sf_dir):
    """The feed as untyped text with injected bad values (fixed rules on seq)."""
    from barlake.operators.transform import raw_as_text

    text = raw_as_text(src.price_feed(spark, sf_dir))
    seq = F.col("seq").cast("bigint")
    return text.select(
        F.when(seq % 97 == 0, F.lit("not a date")).otherwise(F.col("Date")).alias("Date"),
        F.when(seq % 79 == 0, F.lower("Ticker")).otherwise(F.col("Ticker")).alias("Ticker"),
        "Open",
        "High",
        "Low",
        F.when(seq % 89 == 0, F.lit("n/a")).otherwise(F.col("Close")).alias("Close"),
        "Adj Close",
        F.when(seq % 83 == 0, F.lit("12.5")).otherwise(F.col("Volume")).alias("Volume"),
        "seq",
    )


@register(
    "coerce_types",
    O.with_ctes(O.FEED)
    + """SELECT "Ticker" AS ticker,
       CASE WHEN seq % 97 = 0 THEN NULL ELSE "Date" END AS price_date,
       CASE WHEN seq % 89 = 0 THEN NULL ELSE "Close" END AS close_price,
       CASE WHEN seq % 83 = 0 THEN 12.5::DOUBLE ELSE CAST("Volume" AS DOUBLE) END AS volume,
       seq
FROM feed""",
)
def coerce_types(spark, sf_dir):
    """Text extract -> typed columns; unparseable dates and numbers become null."""
    from barlake.operators.transform import coerce_types as coerce, standardize_columns

    typed = coerce(standardize_columns(_text_feed(spark, sf_dir)))
    return typed.select(
        "ticker", "price_date", "close_price", "volume", F.col("seq").cast("bigint").alias("seq")
    )


@register(
    "wide_to_long",
    O.with_ctes(O.FEED)
    + f""", days AS (SELECT DISTINCT "Date" FROM feed),
tk AS (SELECT DISTINCT {O.FEED_TICKER} AS "Ticker" FROM customer),
last AS (
  SELECT "Date", "Ticker", arg_max("Open", seq) AS "Open", arg_max("Close", seq) AS "Close",
         arg_max("Volume", seq) AS "Volume"
  FROM feed GROUP BY 1, 2)
SELECT d."Date", tk."Ticker", l."Open", l."Close", l."Volume"
FROM days d CROSS JOIN tk LEFT JOIN last l ON l."Date" = d."Date" AND l."Ticker" = tk."Ticker"
""",
)
def wide_to_long(spark, sf_dir):
    """Wide per-date frame with <Field>_<Ticker> columns -> long rows with a Ticker column."""
    from barlake.operators.transform import wide_to_long as unpivot

    long = unpivot(src.wide_price_feed(spark, sf_dir), "Date")
    return long.select("Date", "Ticker", "Open", "Close", "Volume")


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------

_DQ_CHECKS = """,
gaps AS (
  SELECT count(*) AS n FROM (
    SELECT date_diff('day', lag(price_date) OVER (PARTITION BY ticker ORDER BY price_date), price_date) AS d
    FROM clean WHERE ticker IS NOT NULL AND price_date IS NOT NULL) WHERE d > 5),
dups AS (
  SELECT coalesce(sum(c), 0) AS n FROM (SELECT count(*) AS c FROM clean GROUP BY ticker, price_date) WHERE c > 1),
cnt AS (
  SELECT count_if(ticker IS NULL) + count_if(regexp_full_match(ticker, '\\s*')) AS null_tickers,
         count_if(price_date IS NULL) AS null_dates,
         count_if(open_price < 0) + count_if(high_price < 0) + count_if(low_price < 0)
           + count_if(close_price < 0) + count_if(adj_close_price < 0) AS negative_prices,
         count_if(volume < 0) AS negative_volume,
         count_if(coalesce(low_price > open_price, false) OR coalesce(low_price > close_price, false)
                  OR coalesce(open_price > high_price, false) OR coalesce(close_price > high_price, false))
           AS price_relationships,
         count_if(ticker IS NOT NULL AND NOT regexp_full_match(ticker, '[A-Z]{1,5}')) AS invalid_ticker_format
  FROM clean)
SELECT * FROM (VALUES
  ('null_tickers', 'CRITICAL', (SELECT null_tickers FROM cnt)),
  ('null_dates', 'CRITICAL', (SELECT null_dates FROM cnt)),
  ('negative_prices', 'CRITICAL', (SELECT negative_prices FROM cnt)),
  ('negative_volume', 'WARNING', (SELECT negative_volume FROM cnt)),
  ('duplicate_rows', 'WARNING', (SELECT n FROM dups)),
  ('price_relationships', 'WARNING', (SELECT price_relationships FROM cnt)),
  ('invalid_ticker_format', 'WARNING', (SELECT invalid_ticker_format FROM cnt)),
  ('date_gaps', 'WARNING', (SELECT n FROM gaps)),
  ('column_types', 'WARNING', (SELECT CASE WHEN count_if(volume <> floor(volume)) > 0 THEN 1 ELSE 0 END FROM clean))
) t("check", severity, failures_raw)
"""


def _dq_sql(rows: str) -> str:
    """The nine checks over the CTE ``clean`` that ``rows`` ends with."""
    return (
        "SELECT \"check\", severity, failures_raw = 0 AS passed, CAST(failures_raw AS BIGINT) AS failures "
        "FROM (" + rows + _DQ_CHECKS + ")"
    )


@register("dq_summary", _dq_sql(O.with_ctes(O.FEED, O.CLEAN)))
def dq_summary(spark, sf_dir):
    """All nine checks on the transformed batch: check, severity, passed, failures."""
    from barlake.operators.quality import quality_results

    return quality_results(_clean(spark, sf_dir)).select("check", "severity", "passed", "failures")


@register(
    "dq_summary_faults",
    _dq_sql(
        O.with_ctes(
            O.FEED,
            """clean AS (
  SELECT CASE WHEN seq % 97 = 0 THEN NULL WHEN seq % 89 = 0 THEN '  ' ELSE "Ticker" END AS ticker,
         CASE WHEN seq % 101 = 0 THEN NULL ELSE "Date" END AS price_date,
         CASE WHEN seq % 103 = 0 THEN -"Open" ELSE "Open" END AS open_price,
         "High" AS high_price, "Low" AS low_price,
         CASE WHEN seq % 107 = 0 THEN -"Close" ELSE "Close" END AS close_price,
         "AdjClose" AS adj_close_price,
         CASE WHEN seq % 109 = 0 THEN -"Volume" WHEN seq % 113 = 0 THEN "Volume" + 0.5::DOUBLE
              ELSE "Volume" END::DOUBLE AS volume
  FROM feed)""",
        )
    ),
)
def dq_summary_faults(spark, sf_dir):
    """All nine checks on the whole raw feed with faults of every kind put in by order key."""
    from barlake.operators.quality import quality_results
    from barlake.operators.transform import coerce_types, standardize_columns

    std = coerce_types(standardize_columns(src.price_feed(spark, sf_dir)))

    def each(n):
        return F.col("seq") % n == 0

    volume = F.col("volume").cast("double")
    faulty = std.withColumns(
        {
            "ticker": F.when(each(97), F.lit(None)).when(each(89), F.lit("  ")).otherwise(F.col("ticker")),
            "price_date": F.when(~each(101), F.col("price_date")),
            "open_price": F.when(each(103), -F.col("open_price")).otherwise(F.col("open_price")),
            "close_price": F.when(each(107), -F.col("close_price")).otherwise(F.col("close_price")),
            "volume": F.when(each(109), -volume).when(each(113), volume + 0.5).otherwise(volume),
        }
    )
    return quality_results(faulty).select("check", "severity", "passed", "failures")


@register(
    "dq_duplicates",
    O.with_ctes(O.FEED)
    + """SELECT "Ticker" AS ticker, "Date" AS price_date, count(*) AS copies
FROM feed GROUP BY 1, 2 HAVING count(*) > 1""",
)
def dq_duplicates(spark, sf_dir):
    """(ticker, day) keys seen more than once in the raw extract, with their copies."""
    from barlake.operators.quality import duplicate_groups
    from barlake.operators.transform import coerce_types, standardize_columns

    std = coerce_types(standardize_columns(src.price_feed(spark, sf_dir)))
    return duplicate_groups(std)


@register(
    "dq_ticker_format",
    O.with_ctes(O.FEED, O.CLEAN)
    + """, bad AS (SELECT ticker FROM clean WHERE ticker IS NOT NULL AND NOT regexp_full_match(ticker, '[A-Z]{1,5}'))
SELECT (SELECT count(*) FROM bad) AS failures,
       (SELECT list(ticker ORDER BY ticker) FROM (SELECT DISTINCT ticker FROM bad ORDER BY ticker LIMIT 5))
         AS examples""",
)
def dq_ticker_format(spark, sf_dir):
    """Malformed tickers: how many rows, and the first five distinct examples."""
    from barlake.operators.quality import quality_results

    res = quality_results(_clean(spark, sf_dir)).where(F.col("check") == "invalid_ticker_format")
    examples = F.from_json(F.col("details"), "examples array<string>")["examples"]
    return res.select("failures", F.coalesce(examples, F.array().cast("array<string>")).alias("examples"))


@register(
    "dq_date_gaps",
    O.with_ctes(O.FEED, O.CLEAN)
    + """SELECT ticker, gap_after, gap_calendar_days FROM (
  SELECT ticker, lag(price_date) OVER (PARTITION BY ticker ORDER BY price_date) AS gap_after,
         date_diff('day', lag(price_date) OVER (PARTITION BY ticker ORDER BY price_date), price_date)
           AS gap_calendar_days
  FROM clean WHERE ticker IS NOT NULL AND price_date IS NOT NULL)
WHERE gap_calendar_days > 5""",
)
def dq_date_gaps(spark, sf_dir):
    """Gaps of more than five days between consecutive dates of a ticker."""
    from barlake.operators.quality import date_gaps

    return date_gaps(_clean(spark, sf_dir))


# ---------------------------------------------------------------------------
# Dimensions and load
# ---------------------------------------------------------------------------

NEW_BATCH_FROM = "1997-10-01"

# stored facts: all before the cut-off; new batch: the feed from NEW_BATCH_FROM
_STORED_SQL = O.clean_cte("stored_all") + f""",
stored AS (SELECT * FROM stored_all
           WHERE price_date < TIMESTAMP '{STORED_CUTOFF}')"""
_BATCH_SQL = O.clean_cte("batch", where=f"\"Date\" >= TIMESTAMP '{NEW_BATCH_FROM}'")
# all rows of the feed, for the queries in which no row is old or new
_ALL_SQL = O.clean_cte("prices")
_COMPANY_SQL = f"""
company AS (
  SELECT {O.FEED_TICKER} AS ticker,
         arg_min(CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN
                   upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) || ' Holdings' END,
                 c_custkey) AS company_name,
         arg_min(CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN r_name END, c_custkey) AS sector,
         arg_min(CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN n_name END, c_custkey) AS industry
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1
)"""
_EXISTING_DIM_SQL = """
existing AS (
  SELECT row_number() OVER (ORDER BY ticker) AS company_id, ticker,
         CASE WHEN ticker LIKE 'B%' THEN NULL ELSE 'Listed ' || ticker END AS company_name,
         CAST(NULL AS VARCHAR) AS sector, CAST(NULL AS VARCHAR) AS industry,
         TIMESTAMP '2000-01-01 00:00:00' AS created_at, TIMESTAMP '2000-01-01 00:00:00' AS updated_at
  FROM (SELECT DISTINCT ticker FROM stored)
)"""


def _stored(spark, sf_dir):
    return _clean(spark, sf_dir).where(
        F.col("price_date") < F.lit(STORED_CUTOFF).cast("timestamp_ntz")
    )


def _new_batch(spark, sf_dir):
    from barlake.operators.transform import transform_prices

    feed = src.price_feed(spark, sf_dir).where(
        F.col("Date") >= F.lit(NEW_BATCH_FROM).cast("timestamp_ntz")
    )
    return transform_prices(feed, loaded_at=_run_ts())


def _existing_dim(spark, sf_dir):
    """A dimension as an earlier run left it: stored tickers, some names missing."""
    from barlake.operators.dims import ticker_bucket
    from barlake.operators.windows import bucketed_ordinal

    t = _stored(spark, sf_dir).select("ticker").distinct()
    ranked = bucketed_ordinal(t, ["ticker"], ticker_bucket(), "_pos")
    old = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    return ranked.select(
        (F.col("_pos") + 1).alias("company_id"),
        "ticker",
        F.when(F.col("ticker").startswith("B"), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Listed "), F.col("ticker")))
        .alias("company_name"),
        F.lit(None).cast("string").alias("sector"),
        F.lit(None).cast("string").alias("industry"),
        old.alias("created_at"),
        old.alias("updated_at"),
    )


def _full_dim(spark, sf_dir):
    from barlake.operators.dims import empty_dim_company, upsert_dim_company

    prices = _clean(spark, sf_dir)
    return upsert_dim_company(
        empty_dim_company(spark), prices.select("ticker"), src.company_source(spark, sf_dir), _run_ts()
    )


@register(
    "dim_date",
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS full_date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
       CAST(week(d) AS INTEGER) AS week_of_year, CAST(isodow(d) - 1 AS INTEGER) AS day_of_week,
       dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
FROM (SELECT DISTINCT o_orderdate AS d FROM orders)""",
)
def dim_date(spark, sf_dir):
    """Calendar attributes (YYYYMMDD id, quarter, ISO week, weekday 0 = Monday, names,
    weekend) of every order date."""
    from barlake.operators.dims import date_attributes

    days = src.read_table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("d")).distinct()
    return days.select(*date_attributes(F.col("d")))


@register(
    "fact_enriched",
    O.with_ctes(O.FEED, _ALL_SQL)
    + f""", dim AS (SELECT ticker, row_number() OVER (ORDER BY ticker) AS company_id
             FROM (SELECT DISTINCT ticker FROM prices WHERE ticker IS NOT NULL))
SELECT b.ticker, date_trunc('day', b.price_date) AS price_date, d.company_id,
       CAST(strftime(b.price_date, '%Y%m%d') AS INTEGER) AS date_id, '{BATCH_ID}' AS batch_id,
       b.close_price
FROM prices b LEFT JOIN dim d ON b.ticker = d.ticker""",
)
def fact_enriched(spark, sf_dir):
    """All rows with company_id (dimension lookup), date_id and batch_id."""
    from barlake.operators.load import enrich_facts

    out = enrich_facts(_clean(spark, sf_dir), _full_dim(spark, sf_dir), BATCH_ID)
    return out.select("ticker", "price_date", "company_id", "date_id", "batch_id", "close_price")


@register(
    "latest_of_day",
    """SELECT upper(event_type) AS ticker, date_trunc('day', ts) AS price_date,
       arg_max(value, row(ts, event_id)) AS close_price, max_by(event_id, row(ts, event_id)) AS seq
FROM events GROUP BY 1, 2""",
)
def latest_of_day(spark, sf_dir):
    """What the load keeps of many stamps a day: the latest time, then the latest arrival."""
    from barlake.operators.load import daily_rows

    stamps = src.read_table(spark, sf_dir, "events").select(
        F.upper("event_type").alias("ticker"),
        F.col("ts").alias("price_date"),
        F.col("value").alias("close_price"),
        F.col("event_id").alias("seq"),
    )
    return daily_rows(stamps)


@register(
    "new_rows",
    O.with_ctes(O.FEED, _STORED_SQL, _BATCH_SQL)
    + """SELECT b.ticker, b.price_date, b.close_price FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.ticker = b.ticker AND s.price_date = b.price_date)""",
)
def new_rows(spark, sf_dir):
    """Batch rows whose (ticker, day) is not stored yet (left anti join)."""
    from barlake.operators.load import daily_rows, new_rows as anti

    batch = daily_rows(_new_batch(spark, sf_dir))
    return anti(batch, _stored(spark, sf_dir), NEW_BATCH_FROM).select("ticker", "price_date", "close_price")


@register(
    "load_counts",
    O.with_ctes(O.FEED, _STORED_SQL, _BATCH_SQL)
    + """SELECT count(*) AS rows_in_batch,
       count_if(s.ticker IS NULL) AS rows_inserted, count_if(s.ticker IS NOT NULL) AS rows_skipped
FROM batch b LEFT JOIN stored s ON s.ticker = b.ticker AND s.price_date = b.price_date""",
)
def load_counts(spark, sf_dir):
    """Rows in the batch, inserted and skipped, in one pass."""
    from barlake.operators.load import daily_rows, load_counts as counts

    return counts(daily_rows(_new_batch(spark, sf_dir)), _stored(spark, sf_dir), NEW_BATCH_FROM)


_REQUESTED_SQL = f"""
requested AS (SELECT DISTINCT {O.FEED_TICKER} AS ticker FROM customer)"""


@register(
    "last_stored_dates",
    O.with_ctes(O.FEED, _ALL_SQL, _REQUESTED_SQL)
    + """SELECT ticker, CAST(max(price_date) AS DATE) AS last_date FROM prices
WHERE ticker IN (SELECT ticker FROM requested) GROUP BY ticker""",
)
def last_stored_dates(spark, sf_dir):
    """Latest stored day per requested ticker; tickers without history are absent."""
    from barlake.operators.extract import normalise_requests
    from barlake.operators.load import last_stored_dates as last

    tickers = normalise_requests(src.requested_tickers(spark, sf_dir))
    return last(_clean(spark, sf_dir), tickers)


@register(
    "existing_keys",
    O.with_ctes(O.FEED, _STORED_SQL, _BATCH_SQL)
    + """SELECT ticker, date_trunc('day', price_date) AS price_date FROM stored
WHERE ticker IN (SELECT ticker FROM batch)""",
)
def existing_keys(spark, sf_dir):
    """Stored (ticker, day) keys of the tickers in the new batch."""
    from barlake.operators.load import existing_keys as keys

    return keys(_stored(spark, sf_dir), _new_batch(spark, sf_dir))


@register(
    "company_info",
    O.with_ctes(O.FEED, _ALL_SQL, _COMPANY_SQL)
    + """SELECT t.ticker, c.company_name, c.sector, c.industry
FROM (SELECT DISTINCT ticker FROM prices WHERE ticker IS NOT NULL) t LEFT JOIN company c USING (ticker)""",
)
def company_info(spark, sf_dir):
    """Name, sector and industry per ticker; nulls where the provider has none."""
    from barlake.operators.extract import company_info as info

    return info(_clean(spark, sf_dir).select("ticker"), src.company_source(spark, sf_dir))


@register(
    "dim_company_upsert",
    O.with_ctes(O.FEED, _STORED_SQL, _BATCH_SQL, _COMPANY_SQL, _EXISTING_DIM_SQL)
    + f""", want AS (SELECT DISTINCT b.ticker, c.company_name, c.sector, c.industry
              FROM batch b LEFT JOIN company c USING (ticker) WHERE b.ticker IS NOT NULL),
kept AS (
  SELECT e.company_id, e.ticker,
         CASE WHEN (e.company_name IS NULL AND w.company_name IS NOT NULL AND w.company_name <> '') THEN w.company_name ELSE e.company_name END AS company_name,
         CASE WHEN (e.company_name IS NULL AND w.company_name IS NOT NULL AND w.company_name <> '') THEN w.sector ELSE e.sector END AS sector,
         CASE WHEN (e.company_name IS NULL AND w.company_name IS NOT NULL AND w.company_name <> '') THEN w.industry ELSE e.industry END AS industry,
         e.created_at,
         CASE WHEN (e.company_name IS NULL AND w.company_name IS NOT NULL AND w.company_name <> '') THEN TIMESTAMP '{RUN_TS}' ELSE e.updated_at END AS updated_at
  FROM existing e LEFT JOIN want w USING (ticker)),
added AS (
  SELECT (SELECT max(company_id) FROM existing) + row_number() OVER (ORDER BY w.ticker) AS company_id,
         w.ticker, w.company_name, w.sector, w.industry,
         TIMESTAMP '{RUN_TS}' AS created_at, TIMESTAMP '{RUN_TS}' AS updated_at
  FROM want w WHERE w.ticker NOT IN (SELECT ticker FROM existing))
SELECT * FROM kept UNION ALL SELECT * FROM added""",
)
def dim_company_upsert(spark, sf_dir):
    """Company dimension after upserting the batch tickers into an earlier dimension."""
    from barlake.operators.dims import upsert_dim_company

    batch = _new_batch(spark, sf_dir)
    return upsert_dim_company(
        _existing_dim(spark, sf_dir), batch.select("ticker"), src.company_source(spark, sf_dir), _run_ts()
    )


@register(
    "migrate_backfill",
    O.with_ctes(O.FEED, _ALL_SQL)
    + """, dim AS (SELECT ticker, row_number() OVER (ORDER BY ticker) AS company_id
             FROM (SELECT DISTINCT ticker FROM prices))
SELECT s.ticker, s.price_date, d.company_id,
       CAST(strftime(s.price_date, '%Y%m%d') AS INTEGER) AS date_id, CAST(NULL AS VARCHAR) AS batch_id
FROM prices s LEFT JOIN dim d USING (ticker)""",
)
def migrate_backfill(spark, sf_dir):
    """Version-1 facts (no company_id, date_id, batch_id) after the migration backfill."""
    from barlake.plans.migrate import migrate_frames

    v1 = _clean(spark, sf_dir).drop("daily_return")
    facts, _dim = migrate_frames(v1, None, _run_ts())
    return facts.select("ticker", "price_date", "company_id", "date_id", "batch_id")


# ---------------------------------------------------------------------------
# Incremental extract (S1-S4, U1, U3) and Bronze
# ---------------------------------------------------------------------------

_WINDOWS_SQL = f"""
last AS (SELECT ticker, CAST(max(price_date) AS DATE) AS last_date FROM stored GROUP BY ticker),
windows AS (
  SELECT r.ticker, l.last_date,
         coalesce(l.last_date - INTERVAL 2 DAY, DATE '{AS_OF}' - INTERVAL 730 DAY)::DATE AS start_date,
         DATE '{AS_OF}' AS end_date
  FROM requested r LEFT JOIN last l USING (ticker))"""


def _windows(spark, sf_dir):
    from barlake.operators.extract import normalise_requests, start_dates
    from barlake.operators.load import last_stored_dates as last

    tickers = normalise_requests(src.requested_tickers(spark, sf_dir))
    stored = _stored(spark, sf_dir)
    return start_dates(tickers, last(stored, tickers), F.lit(AS_OF).cast("date"))


def _extract(spark, sf_dir):
    from barlake.operators.extract import incremental_extract as extract

    return extract(src.price_feed(spark, sf_dir), _windows(spark, sf_dir))


@register(
    "ticker_list",
    O.with_ctes(_REQUESTED_SQL) + "SELECT ticker FROM requested",
)
def ticker_list(spark, sf_dir):
    """Typed request strings -> distinct tickers (trim, upper, blanks dropped)."""
    from barlake.operators.extract import normalise_requests

    return normalise_requests(src.requested_tickers(spark, sf_dir))


@register(
    "extract_window",
    O.with_ctes(O.FEED, _STORED_SQL, _REQUESTED_SQL, _WINDOWS_SQL) + "SELECT * FROM windows",
)
def extract_window(spark, sf_dir):
    """Per requested ticker: last stored day, start (last - 2 days, else today - 730) and end."""
    return _windows(spark, sf_dir)


@register(
    "incremental_extract",
    O.with_ctes(O.FEED, _STORED_SQL, _REQUESTED_SQL, _WINDOWS_SQL)
    + """SELECT f."Ticker", f."Date", f."Close", f.seq FROM feed f JOIN windows w
  ON f."Ticker" = w.ticker AND f."Date" >= CAST(w.start_date AS TIMESTAMP)
 AND f."Date" < CAST(w.end_date AS TIMESTAMP)""",
)
def incremental_extract(spark, sf_dir):
    """Raw rows of each requested ticker inside its own date window."""
    return _extract(spark, sf_dir).select("Ticker", "Date", "Close", "seq")


@register(
    "failed_tickers",
    O.with_ctes(O.FEED, _STORED_SQL, _REQUESTED_SQL, _WINDOWS_SQL)
    + """SELECT ticker FROM requested WHERE ticker NOT IN (
  SELECT DISTINCT f."Ticker" FROM feed f JOIN windows w
    ON f."Ticker" = w.ticker AND f."Date" >= CAST(w.start_date AS TIMESTAMP)
   AND f."Date" < CAST(w.end_date AS TIMESTAMP))""",
)
def failed_tickers(spark, sf_dir):
    """Requested tickers that returned no rows in their window."""
    from barlake.operators.extract import failed_tickers as failed, normalise_requests

    requested = normalise_requests(src.requested_tickers(spark, sf_dir))
    return failed(requested, _extract(spark, sf_dir))


@register(
    "union_extracts",
    O.with_ctes(O.FEED)
    + f"""SELECT "Ticker", "Date", "Close", CASE WHEN {O.VALID_TICKER.format('"Ticker"')}
       THEN "AdjClose" END AS "Adj Close", seq FROM feed""",
)
def union_extracts(spark, sf_dir):
    """Per-source extracts with different columns, unioned by name (missing -> null)."""
    from barlake.operators.extract import union_extracts as union
    from barlake.schemas import TICKER_PATTERN

    feed = src.price_feed(spark, sf_dir)
    ok = F.col("Ticker").rlike(TICKER_PATTERN)
    a = feed.where(ok).select("Ticker", "Date", "Close", "Adj Close", "seq")
    b = feed.where(~ok).select("seq", "Date", "Ticker", "Close")
    return union(a, b)


@register(
    "bronze_partitions",
    O.with_ctes(O.FEED)
    + """SELECT "Ticker" AS ticker, CAST(year("Date") AS INTEGER) AS year, count(*) AS files_rows
FROM feed GROUP BY 1, 2""",
)
def bronze_partitions(spark, sf_dir):
    """Bronze partition values (ticker, own year) and rows landed in each."""
    from barlake.sources.bronze import with_partitions

    parts = with_partitions(src.price_feed(spark, sf_dir))
    return parts.groupBy("ticker", "year").agg(F.count("*").alias("files_rows"))


@register(
    "bronze_scan",
    O.with_ctes(O.FEED)
    + """SELECT "Ticker" AS ticker, "Date", "Close" AS price, CAST("Volume" AS BIGINT) AS volume
FROM feed WHERE "Close" IS NOT NULL""",
)
def bronze_scan(spark, sf_dir):
    """Replay rows from Bronze-shaped data: ticker, Date, price, volume; no close -> dropped."""
    from barlake.sources.bronze import replay_rows

    feed = src.price_feed(spark, sf_dir).withColumnRenamed("Ticker", "ticker")
    return replay_rows(feed, order_col=None, dedupe=False)


REPLAY_T0 = "2024-01-01 00:00:00"


@register(
    "replay_schedule",
    O.with_ctes(O.FEED)
    + f""", rows AS (SELECT "Ticker" AS ticker, "Date", arg_max("Close", seq) AS price,
                    CAST(arg_max("Volume", seq) AS BIGINT) AS volume FROM feed GROUP BY 1, 2)
SELECT ticker, "Date", price, volume,
       row_number() OVER (ORDER BY "Date", ticker) - 1 AS ordinal,
       TIMESTAMP '{REPLAY_T0}' + to_microseconds((row_number() OVER (ORDER BY "Date", ticker) - 1) * 100000)
         AS event_time
FROM rows""",
)
def replay_schedule(spark, sf_dir):
    """Bronze rows in (Date, ticker) order, one tick every 0.1 s (10 ticks/s)."""
    from barlake.operators.replay import replay_schedule as schedule
    from barlake.sources.bronze import replay_rows

    feed = src.price_feed(spark, sf_dir).withColumnRenamed("Ticker", "ticker")
    rows = replay_rows(feed, order_col="seq", dedupe=True)
    return schedule(rows, F.lit(REPLAY_T0).cast("timestamp_ntz"), 10.0)


# ---------------------------------------------------------------------------
# Tick messages, validation, dead letters
# ---------------------------------------------------------------------------

_MSG_SQL = """
msgs AS (
  SELECT event_id, upper(trim(event_type)) AS key, event_id % 40 AS kind, value AS price,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume, ts
  FROM events)"""
# The first failing rule wins, in rule order, applied to the values each
# message actually carries (base data may hold a zero price, for example).
_REASON_SQL = """CASE
  WHEN kind = 7 THEN 'payload is not a JSON object'
  WHEN kind = 1 THEN 'missing fields: source'
  WHEN kind = 8 THEN 'missing fields: producer_id'
  WHEN kind = 4 THEN 'ticker must be a non-empty string'
  WHEN kind = 5 THEN 'price is not numeric'
  WHEN (CASE WHEN kind = 0 THEN -price ELSE price END) <= 0 THEN 'price must be positive'
  WHEN kind = 9 THEN 'volume is not numeric'
  WHEN (CASE WHEN kind = 6 THEN -volume - 1 ELSE volume END) < 0 THEN 'volume must be non-negative'
  WHEN kind = 2 THEN 'event_time is not ISO-8601'
  WHEN kind = 3 THEN 'source must be one of (''live'', ''replay'')'
  ELSE 'ok' END"""


@register(
    "tick_messages",
    """SELECT event_id, upper(trim(event_type)) AS key,
       json_object('ticker', upper(trim(event_type)), 'price', value,
                   'volume', TRY_CAST(json_extract_string(props, '$.k') AS BIGINT),
                   'event_time', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00',
                   'source', 'replay', 'producer_id', 'events')::VARCHAR AS value
FROM events""",
)
def tick_messages(spark, sf_dir):
    """Keyed JSON tick messages (key = ticker) built from events."""
    return src.tick_messages(spark, sf_dir, with_faults=False)


def _checked(spark, sf_dir):
    from barlake.functions.ticks import with_tick_check

    return with_tick_check(src.tick_messages(spark, sf_dir, with_faults=True), "value")


@register("tick_reject_reasons", O.with_ctes(_MSG_SQL) + f"SELECT event_id, {_REASON_SQL} AS reason FROM msgs")
def tick_reject_reasons(spark, sf_dir):
    """Every message with its validation verdict: 'ok' or the first failing rule."""
    return _checked(spark, sf_dir).select("event_id", "reason")


@register(
    "dead_letters",
    O.with_ctes(_MSG_SQL)
    + f"SELECT event_id, key, reason FROM (SELECT *, {_REASON_SQL} AS reason FROM msgs) WHERE reason <> 'ok'",
)
def dead_letters(spark, sf_dir):
    """Messages routed to the dead-letter sink (the exact complement of valid ticks)."""
    checked = _checked(spark, sf_dir)
    return checked.where(F.col("reason") != "ok").select("event_id", "key", "reason")


@register(
    "valid_ticks",
    O.with_ctes(_MSG_SQL)
    + f"""SELECT event_id, key AS ticker, price, volume, ts AS event_time
FROM (SELECT *, {_REASON_SQL} AS reason FROM msgs) WHERE reason = 'ok'""",
)
def valid_ticks(spark, sf_dir):
    """Valid messages parsed to typed ticks (ticker normalised, time as naive UTC)."""
    ok = _checked(spark, sf_dir).where(F.col("reason") == "ok")
    return ok.select(
        "event_id",
        F.col("t_ticker").alias("ticker"),
        F.col("t_price").alias("price"),
        F.col("t_volume").alias("volume"),
        F.col("t_event_time").alias("event_time"),
    )


# ---------------------------------------------------------------------------
# Marts over the star schema
# ---------------------------------------------------------------------------

_FACT_SQL = O.clean_cte() + ",\n" + _COMPANY_SQL.strip() + """,
dim AS (SELECT t.ticker, row_number() OVER (ORDER BY t.ticker) AS company_id, c.company_name, c.sector
        FROM (SELECT DISTINCT ticker FROM clean WHERE ticker IS NOT NULL) t LEFT JOIN company c USING (ticker)),
fact AS (
  SELECT c.ticker, c.price_date, c.close_price, c.volume, c.daily_return, d.company_id, d.company_name,
         d.sector, CAST(strftime(c.price_date, '%Y%m%d') AS INTEGER) AS date_id
  FROM clean c LEFT JOIN dim d USING (ticker))"""


def _fact(spark, sf_dir):
    from barlake.operators.dims import empty_dim_company, upsert_dim_company
    from barlake.operators.load import enrich_facts

    clean = _clean(spark, sf_dir)
    dim = upsert_dim_company(
        empty_dim_company(spark), clean.select("ticker"), src.company_source(spark, sf_dir), _run_ts()
    )
    return enrich_facts(clean, dim, BATCH_ID), dim


def _fact_rows(spark, sf_dir):
    """Fact rows for measures that need no company attributes (no dimension build)."""
    from barlake.functions.timecols import date_id

    return _clean(spark, sf_dir).withColumn("date_id", date_id(F.col("price_date")))


def _star(spark, sf_dir):
    from barlake.operators.marts import star

    fact, dim = _fact(spark, sf_dir)
    return star(fact, dim, _calendar(spark, sf_dir))


def _calendar(spark, sf_dir):
    """Calendar rows of the days that the feed has: no fixed range that could cut any."""
    from barlake.operators.dims import date_attributes

    days = src.read_table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("d")).distinct()
    return days.select(*date_attributes(F.col("d")))


@register(
    "latest_close",
    O.with_ctes(O.FEED, _FACT_SQL)
    + f""", last AS (SELECT ticker, max(price_date) AS price_date FROM fact GROUP BY ticker)
SELECT f.ticker, f.price_date, {O.exact_mean("f.close_price")} AS latest_close
FROM fact f JOIN last l ON f.ticker = l.ticker AND f.price_date = l.price_date GROUP BY 1, 2
UNION ALL
SELECT '(all)', price_date, {O.exact_mean("close_price")} FROM fact
WHERE price_date = (SELECT max(price_date) FROM fact) GROUP BY 2""",
)
def latest_close(spark, sf_dir):
    """Average close on the latest date, per ticker and overall."""
    from barlake.operators.marts import latest_close as measure

    out = measure(_fact_rows(spark, sf_dir))
    return out


@register(
    "return_30d",
    O.with_ctes(O.FEED, _FACT_SQL)
    + f""", last AS (SELECT ticker, max(price_date) AS latest_date FROM fact GROUP BY ticker),
s1 AS (
  SELECT f.ticker, l.latest_date,
         {O.exact_mean("f.close_price", "f.price_date = l.latest_date")} AS latest_close,
         max(f.price_date) FILTER (WHERE f.price_date <= l.latest_date - INTERVAL 30 DAY) AS prior_date
  FROM fact f JOIN last l USING (ticker) GROUP BY 1, 2),
pr AS (SELECT f.ticker, {O.exact_mean("f.close_price")} AS prior_close FROM fact f
       JOIN s1 ON f.ticker = s1.ticker AND f.price_date = s1.prior_date GROUP BY 1)
SELECT s1.ticker, latest_date, latest_close, prior_date, prior_close,
       (latest_close - prior_close) / prior_close AS return_30d
FROM s1 LEFT JOIN pr USING (ticker)""",
)
def return_30d(spark, sf_dir):
    """Per ticker: return from the last close at least 30 days back to the latest close."""
    from barlake.operators.marts import return_30d as measure

    out = measure(_fact_rows(spark, sf_dir))
    return out.select(
        "ticker",
        "latest_date",
        "latest_close",
        "prior_date",
        "prior_close",
        "return_30d",
    )


_RUNS_SQL = """
runs AS (
  SELECT o_orderdate + INTERVAL 1350 MINUTE AS started_at,
         CASE WHEN count_if(o_orderstatus = 'P') > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
         CASE WHEN count_if(o_orderstatus = 'P') > 0 THEN 0 ELSE count_if(o_orderstatus = 'F') END
           AS rows_inserted,
         CASE WHEN count_if(o_orderstatus = 'P') > 0
              THEN 'Critical quality checks failed: null_tickers' END AS error_message
  FROM orders GROUP BY o_orderdate)"""


@register(
    "load_success_rate",
    O.with_ctes(_RUNS_SQL)
    + """SELECT count(*) AS runs, count_if(status = 'SUCCESS') AS successful,
       count_if(status = 'SUCCESS') / count(*) AS success_rate FROM runs""",
)
def load_success_rate(spark, sf_dir):
    """Share of successful pipeline runs in the audit table."""
    from barlake.operators.marts import load_success_rate as measure

    out = measure(src.pipeline_runs_source(spark, sf_dir))
    return out


@register(
    "run_health",
    O.with_ctes(_RUNS_SQL) + "SELECT started_at, status, CAST(rows_inserted AS BIGINT) AS rows_inserted, error_message FROM runs",
)
def run_health(spark, sf_dir):
    """Pipeline-run table for the health page, newest first."""
    from barlake.operators.marts import run_health as table

    return table(src.pipeline_runs_source(spark, sf_dir))


@register(
    "price_trend",
    O.with_ctes(O.FEED, _FACT_SQL)
    + f"SELECT price_date AS full_date, company_name, {O.exact_mean('close_price')} AS avg_close "
    "FROM fact GROUP BY 1, 2",
)
def price_trend(spark, sf_dir):
    """Average close per day and company (the headline line chart)."""
    from barlake.operators.marts import price_trend as measure

    return measure(_star(spark, sf_dir))


@register(
    "return_histogram",
    O.with_ctes(O.FEED, _FACT_SQL)
    + """SELECT ticker, CAST(floor(daily_return / 0.005) AS BIGINT) AS bin, count(*) AS days
FROM fact WHERE daily_return IS NOT NULL GROUP BY 1, 2""",
)
def return_histogram(spark, sf_dir):
    """Daily-return distribution per ticker in 0.005 bins."""
    from barlake.operators.marts import return_histogram as measure

    return measure(_fact_rows(spark, sf_dir))


def _month_sums_sql() -> str:
    from barlake.schemas import MONTH_NAMES

    cols = ", ".join(
        f"CAST(sum(volume) FILTER (WHERE monthname(price_date) = '{m}') AS BIGINT) AS \"{m}\""
        for m in MONTH_NAMES
    )
    return f"SELECT ticker, {cols} FROM fact GROUP BY ticker"


@register("volume_matrix", O.with_ctes(O.FEED, _FACT_SQL) + _month_sums_sql())
def volume_matrix(spark, sf_dir):
    """Ticker x month matrix of summed volume."""
    from barlake.operators.marts import volume_matrix as measure, with_calendar

    return measure(with_calendar(_fact_rows(spark, sf_dir), _calendar(spark, sf_dir)))


@register(
    "star_slice",
    O.with_ctes(O.FEED, _FACT_SQL)
    + """SELECT ticker, price_date AS full_date, company_name, sector, close_price FROM fact
WHERE company_name = 'Building Holdings' AND year(price_date) = 1998""",
)
def star_slice(spark, sf_dir):
    """Star join sliced by company name and year."""
    from barlake.operators.marts import slice_star

    s = slice_star(_star(spark, sf_dir), "Building Holdings", 1998)
    return s.select("ticker", "full_date", "company_name", "sector", "close_price")


@register(
    "latest_facts",
    O.with_ctes(O.FEED, _FACT_SQL)
    + "SELECT ticker, price_date, close_price FROM fact ORDER BY price_date DESC, ticker LIMIT 10",
)
def latest_facts(spark, sf_dir):
    """The ten newest fact rows (a top-k report)."""
    from barlake.operators.marts import latest_facts as top

    return top(_fact_rows(spark, sf_dir)).select("ticker", "price_date", "close_price")


STREAM_NOW = "2024-01-31 00:00:00"


@register(
    "stream_health",
    O.with_ctes(O.TICKS, O.bars_cte("1 minute", "minute"), O.scored_cte(300))
    + f""", b AS (SELECT window_end + INTERVAL 30 SECOND AS processed_at FROM bars)
SELECT (SELECT count(*) FROM b) AS total_bars,
       (SELECT count(*) FROM b WHERE processed_at >= TIMESTAMP '{STREAM_NOW}' - INTERVAL 5 MINUTE) AS bars_last_5min,
       (SELECT max(processed_at) FROM b) AS latest_processed_at,
       (SELECT count(*) FROM scored WHERE reference_avg IS NOT NULL AND abs({O.MOVE_PCT}) > 2.0) AS total_alerts""",
)
def stream_health(spark, sf_dir):
    """Bars total, bars processed in the last 5 minutes, alerts, latest processed_at."""
    from barlake.operators.marts import stream_health as health

    bars = _bars(spark, sf_dir).withColumn(
        "processed_at", F.timestamp_add("SECOND", F.lit(30), F.col("window_end"))
    )
    alerts = bars_ops.price_alerts(bars_ops.with_reference_average(bars, 300), 2.0)
    return health(bars, alerts, F.lit(STREAM_NOW).cast("timestamp_ntz"))


@register(
    "tick_parse",
    O.with_ctes(_MSG_SQL)
    + """SELECT event_id,
       CASE kind WHEN 4 THEN '   ' WHEN 7 THEN NULL ELSE key END AS ticker,
       CASE kind WHEN 0 THEN -price WHEN 5 THEN NULL WHEN 7 THEN NULL ELSE price END AS price,
       CASE kind WHEN 6 THEN -volume - 1 WHEN 9 THEN NULL WHEN 7 THEN NULL ELSE volume END AS volume,
       CASE kind WHEN 2 THEN NULL WHEN 7 THEN NULL ELSE ts END AS event_time,
       CASE kind WHEN 1 THEN NULL WHEN 3 THEN 'manual' WHEN 7 THEN NULL ELSE 'replay' END AS source,
       CASE kind WHEN 8 THEN NULL WHEN 7 THEN NULL ELSE 'events' END AS producer_id
FROM msgs""",
)
def tick_parse(spark, sf_dir):
    """Every raw message parsed beside its text (PERMISSIVE: a bad field is null),
    struct fields projected and the ISO time parsed."""
    from barlake.functions.ticks import parse_tick
    from barlake.functions.timecols import iso_string_to_ntz

    msgs = src.tick_messages(spark, sf_dir, with_faults=True)
    parsed = msgs.withColumn("tick", parse_tick(F.col("value")))
    return parsed.select(
        "event_id",
        "tick.ticker",
        "tick.price",
        "tick.volume",
        iso_string_to_ntz(F.col("tick.event_time")).alias("event_time"),
        "tick.source",
        "tick.producer_id",
    )
