"""Table schemas and fixed values, declared in one place.

Stored times are naive UTC and use ``TIMESTAMP_NTZ`` so that results do not
depend on the reader's session time zone. The streaming lane casts event times
to ``TIMESTAMP`` only where the watermark needs it.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference behaviour for right results.
# ---------------------------------------------------------------------------
PRICE_COLUMNS = ["open_price", "high_price", "low_price", "close_price", "adj_close_price"]
CRITICAL_CHECKS = ("null_tickers", "null_dates", "negative_prices")
CHECK_ORDER = (
    "null_tickers",
    "null_dates",
    "negative_prices",
    "negative_volume",
    "duplicate_rows",
    "price_relationships",
    "invalid_ticker_format",
    "date_gaps",
    "column_types",
)
TICKER_PATTERN = "^[A-Z]{1,5}$"
TICKER_EXAMPLES = 5
DATE_GAP_DAYS = 5
DATE_COLUMN_NAMES = ("date", "datetime", "price_date")
RAW_RENAMES = {
    "Ticker": "ticker",
    "Open": "open_price",
    "High": "high_price",
    "Low": "low_price",
    "Close": "close_price",
    "Adj Close": "adj_close_price",
    "Volume": "volume",
}
RAW_FIELDS = ("Open", "High", "Low", "Close", "Adj Close", "Volume")
REQUIRED_COLUMNS = (
    "ticker",
    "price_date",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "adj_close_price",
    "volume",
)
OUTPUT_COLUMNS = [
    "ticker",
    "price_date",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "adj_close_price",
    "volume",
    "daily_return",
    "loaded_at",
]
LOOKBACK_DAYS = 730
OVERLAP_DAYS = 2
TICK_TOPIC = "stock-ticks"
DLQ_TOPIC = "stock-ticks-dlq"
REQUIRED_TICK_FIELDS = ("ticker", "price", "volume", "event_time", "source", "producer_id")
VALID_SOURCES = ("live", "replay")
TICK_REASONS = {
    "ok": "ok",
    "ticker": "ticker must be a non-empty string",
    "price_type": "price is not numeric",
    "price_sign": "price must be positive",
    "volume_type": "volume is not numeric",
    "volume_sign": "volume must be non-negative",
    "time": "event_time is not ISO-8601",
    "source": "source must be one of ('live', 'replay')",
    "missing_prefix": "missing fields: ",
}
WATERMARK_DELAY = "30 seconds"
BAR_WIDTH = "1 minute"
REFERENCE_LOOKBACK_SECONDS = 300
ALERT_THRESHOLD_PCT = 2.0
TRIGGER_INTERVAL = "30 seconds"
REPLAY_SPEED = 10.0
MAX_CONSUMER_LAG = 1000
HEALTH_RECENT_MINUTES = 5
RETURN_BIN_WIDTH = 0.005
RETURN_LOOKBACK_DAYS = 30
DIM_DATE_START = "2000-01-01"
DIM_DATE_END = "2035-12-31"
MONTH_NAMES = [
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
]
STATUS_SUCCESS = "SUCCESS"
STATUS_FAILED = "FAILED"
BRONZE_TARGETS = ("local", "azure")
CRITICAL_ERROR_PREFIX = "Critical quality checks failed: "
FRACTIONAL_VOLUME_ISSUE = "volume contains non-integer float values"
REPORT_FILE = "quality_report_{batch_id}.json"
# ---------------------------------------------------------------------------


def _f(name, dtype, nullable=True):
    return StructField(name, dtype, nullable)


PIPELINE_RUNS = StructType(
    [
        _f("run_id", LongType()),
        _f("batch_id", StringType(), False),
        _f("started_at", TimestampNTZType(), False),
        _f("completed_at", TimestampNTZType()),
        _f("status", StringType(), False),
        _f("tickers", StringType()),
        _f("rows_extracted", LongType()),
        _f("rows_inserted", LongType()),
        _f("rows_skipped", LongType()),
        _f("quality_checks_passed", BooleanType()),
        _f("error_message", StringType()),
    ]
)

DIM_COMPANY = StructType(
    [
        _f("company_id", LongType()),
        _f("ticker", StringType(), False),
        _f("company_name", StringType()),
        _f("sector", StringType()),
        _f("industry", StringType()),
        _f("created_at", TimestampNTZType(), False),
        _f("updated_at", TimestampNTZType(), False),
    ]
)

DIM_DATE = StructType(
    [
        _f("date_id", IntegerType(), False),
        _f("full_date", TimestampNTZType(), False),
        _f("year", IntegerType()),
        _f("quarter", IntegerType()),
        _f("month", IntegerType()),
        _f("month_name", StringType()),
        _f("week_of_year", IntegerType()),
        _f("day_of_week", IntegerType()),
        _f("day_name", StringType()),
        _f("is_weekend", BooleanType()),
    ]
)

FACT_INTRADAY_BARS = StructType(
    [
        _f("ticker", StringType(), False),
        _f("window_start", TimestampNTZType(), False),
        _f("window_end", TimestampNTZType(), False),
        _f("open", DoubleType()),
        _f("high", DoubleType()),
        _f("low", DoubleType()),
        _f("close", DoubleType()),
        _f("volume", LongType()),
        _f("tick_count", LongType()),
        _f("avg_close_5min", DoubleType()),
        _f("processed_at", TimestampNTZType(), False),
    ]
)

ALERTS = StructType(
    [
        _f("alert_id", LongType()),
        _f("ticker", StringType(), False),
        _f("window_start", TimestampNTZType(), False),
        _f("close", DoubleType()),
        _f("reference_avg", DoubleType()),
        _f("move_pct", DoubleType()),
        _f("threshold_pct", DoubleType()),
        _f("created_at", TimestampNTZType(), False),
    ]
)

FACT_STOCK_PRICES = StructType(
    [
        _f("ticker", StringType(), False),
        _f("price_date", TimestampNTZType(), False),
        _f("open_price", DoubleType()),
        _f("high_price", DoubleType()),
        _f("low_price", DoubleType()),
        _f("close_price", DoubleType()),
        _f("adj_close_price", DoubleType()),
        _f("volume", LongType()),
        _f("daily_return", DoubleType()),
        _f("loaded_at", TimestampNTZType(), False),
        _f("company_id", LongType()),
        _f("date_id", IntegerType()),
        _f("batch_id", StringType()),
    ]
)

TICK = StructType(
    [
        _f("ticker", StringType()),
        _f("price", DoubleType()),
        _f("volume", LongType()),
        _f("event_time", StringType()),
        _f("source", StringType()),
        _f("producer_id", StringType()),
    ]
)

QUALITY_RESULTS = StructType(
    [
        _f("check", StringType(), False),
        _f("severity", StringType(), False),
        _f("passed", BooleanType(), False),
        _f("failures", LongType(), False),
        _f("details", StringType()),
    ]
)

WAREHOUSE_TABLES = {
    "pipeline_runs": PIPELINE_RUNS,
    "dim_company": DIM_COMPANY,
    "dim_date": DIM_DATE,
    "fact_intraday_bars": FACT_INTRADAY_BARS,
    "alerts": ALERTS,
    "fact_stock_prices": FACT_STOCK_PRICES,
}
