"""DuckDB SQL that repeats the adapter rules of ``barlake.sources.testdata``.

Used only by the oracle queries in ``barlake.plans.catalog``; the tables
(events, orders, customer, ...) are views the checker registers.
"""

from __future__ import annotations

TICKS = """
ticks AS (
  SELECT event_id,
         upper(event_type) AS ticker,
         value AS price,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume,
         ts AS event_time
  FROM events
)"""


def digits(x: str) -> str:
    """A double as the decimal number that its shortest text form shows."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18))"


def bars_cte(width: str, trunc: str) -> str:
    """Bars of ``width``; ``trunc`` is the DuckDB date_trunc unit with the same alignment."""
    return f"""
bars AS (
  SELECT ticker,
         date_trunc('{trunc}', event_time) AS window_start,
         date_trunc('{trunc}', event_time) + INTERVAL {width} AS window_end,
         arg_min(price, row(event_time, price)) AS open,
         max(price) AS high,
         min(price) AS low,
         arg_max(price, row(event_time, price)) AS close,
         CAST(sum(volume) AS BIGINT) AS volume,
         count(*) AS tick_count
  FROM ticks
  GROUP BY ALL
)"""


def scored_cte(lookback_seconds: int) -> str:
    return f"""
scored AS (
  SELECT *,
         CAST(CAST(sum({digits("close")}) OVER w AS VARCHAR) AS DOUBLE) / count(close) OVER w AS reference_avg
  FROM bars
  WINDOW w AS (PARTITION BY ticker ORDER BY window_start
               RANGE BETWEEN INTERVAL {lookback_seconds} SECONDS PRECEDING
                         AND INTERVAL 1 SECONDS PRECEDING)
)"""


def exact_mean(x: str, where: str = "") -> str:
    """Mean as the sum of the values' decimal digits over their count."""
    only = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(CAST(sum({digits(x)}){only} AS VARCHAR) AS DOUBLE) / count({x}){only}"


MOVE_PCT = "CASE WHEN reference_avg = 0 THEN 0.0 ELSE (close - reference_avg) / reference_avg * 100.0 END"

VALID_TICKER = "regexp_full_match({0}, '[A-Z]{{1,5}}')"

FEED_TICKER = (
    "CASE WHEN c_acctbal < 0 THEN upper(substr(c_mktsegment, 1, 3)) || CAST(c_nationkey AS VARCHAR) "
    "ELSE upper(substr(c_mktsegment, 1, 5)) END"
)

# raw flat extract (Date, Ticker, Open, High, Low, Close, AdjClose, Volume, seq)
FEED = f"""
feed AS (
  SELECT o_orderdate AS "Date",
         <<TICKER>> AS "Ticker",
         (o_totalprice / 100.0::DOUBLE) * (0.98::DOUBLE + 0.01::DOUBLE * (o_custkey % 5)) AS "Open",
         greatest((o_totalprice / 100.0::DOUBLE) * (0.98::DOUBLE + 0.01::DOUBLE * (o_custkey % 5)),
                  o_totalprice / 100.0::DOUBLE) * 1.01::DOUBLE AS "High",
         CASE WHEN o_orderpriority = '1-URGENT' THEN (o_totalprice / 100.0::DOUBLE) * 1.005::DOUBLE
              ELSE least((o_totalprice / 100.0::DOUBLE) * (0.98::DOUBLE + 0.01::DOUBLE * (o_custkey % 5)),
                         o_totalprice / 100.0::DOUBLE) * 0.99::DOUBLE END AS "Low",
         o_totalprice / 100.0::DOUBLE AS "Close",
         (o_totalprice / 100.0::DOUBLE) * 0.98::DOUBLE AS "AdjClose",
         o_custkey * 100 AS "Volume",
         o_orderkey AS seq
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""
FEED_MANY_KEYS = FEED.replace("<<TICKER>>", "'C' || CAST(o_custkey AS VARCHAR)")
FEED = FEED.replace("<<TICKER>>", FEED_TICKER)

def clean_cte(name: str = "clean", feed: str = "feed", where: str = "TRUE") -> str:
    """Transformed batch: keep-last per (ticker, day) by seq, then the daily return."""
    return f"""
{name}_typed AS (
  SELECT "Ticker" AS ticker, "Date" AS price_date, "Open" AS open_price, "High" AS high_price,
         "Low" AS low_price, "Close" AS close_price, "AdjClose" AS adj_close_price,
         "Volume" AS volume, seq
  FROM {feed} WHERE {where}
),
{name}_dedup AS (
  SELECT ticker, price_date,
         arg_max(open_price, seq) AS open_price, arg_max(high_price, seq) AS high_price,
         arg_max(low_price, seq) AS low_price, arg_max(close_price, seq) AS close_price,
         arg_max(adj_close_price, seq) AS adj_close_price, arg_max(volume, seq) AS volume,
         max(seq) AS seq
  FROM {name}_typed GROUP BY ticker, price_date
),
{name} AS (
  SELECT *,
         close_price / lag(close_price) OVER (PARTITION BY ticker ORDER BY price_date) - 1.0 AS daily_return
  FROM {name}_dedup
)"""


CLEAN = clean_cte()

def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
