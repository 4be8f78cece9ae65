"""Declared schemas and fixed reference values.

Nothing here is inferred at run time: ticks, topic records, bars and
reports all have a fixed shape.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Tick message as it travels on the tick topic (JSON value).
TICK = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("asset_type", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("bid", T.DoubleType()),
    T.StructField("ask", T.DoubleType()),
    T.StructField("spread", T.DoubleType()),
    T.StructField("returns_pct", T.DoubleType()),
    T.StructField("sma5", T.DoubleType()),
    T.StructField("sma20", T.DoubleType()),
    T.StructField("realized_vol", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("is_anomaly", T.BooleanType()),
    T.StructField("anomaly_type", T.StringType()),
    T.StructField("signal", T.StringType()),
    T.StructField("tick_number", T.LongType()),
])
TICK_FIELDS = [f.name for f in TICK.fields]

# Kafka-shaped record: what the broker source yields (and what our
# file-fed replay writes).
TOPIC_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# Stored OHLCV bar (plus batch_id: which micro-batch wrote this version).
BAR_FIELDS = [
    "window_start", "window_end", "symbol", "asset_type",
    "open", "high", "low", "close", "volume", "vwap",
    "avg_realized_vol", "avg_spread", "tick_count", "alert_count",
    "avg_return_pct", "stddev_return_pct",
]
BAR_NOT_NULL = ["window_start", "window_end", "symbol"]
# Decimal places used when bars are compared or staged.
BAR_ROUNDING = {
    "vwap": 4, "avg_realized_vol": 6, "avg_spread": 6,
    "avg_return_pct": 4, "stddev_return_pct": 4,
}

# Alert value: the 8 fields of an alert message.
ALERT_FIELDS = ["symbol", "asset_type", "timestamp", "price", "returns_pct",
                "volume", "price_alert", "alert_severity"]

# Stored bar version: what the bar store declares (window and symbol NOT NULL, checked by the quality job).
BAR = T.StructType(
    [T.StructField("window_start", T.TimestampNTZType(), False), T.StructField("window_end", T.TimestampNTZType(), False),
     T.StructField("symbol", T.StringType(), False), T.StructField("asset_type", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close")]
    + [T.StructField("volume", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in ("vwap", "avg_realized_vol", "avg_spread")]
    + [T.StructField(c, T.LongType()) for c in ("tick_count", "alert_count")]
    + [T.StructField(c, T.DoubleType()) for c in ("avg_return_pct", "stddev_return_pct")]
    + [T.StructField("created_at", T.TimestampNTZType()), T.StructField("batch_id", T.LongType())])

REPORT = T.StructType([
    T.StructField("report_hour", T.TimestampNTZType(), False),
    T.StructField("checks_passed", T.LongType()),
    T.StructField("checks_failed", T.LongType()),
    T.StructField("details", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# ---------------------------------------------------------------------------
# Market registry: symbol, initial price, asset type, currency.
MARKET_ASSETS = [
    ("AAPL", 182.50, "stock", "USD"),
    ("TSLA", 245.00, "stock", "USD"),
    ("MSFT", 375.20, "stock", "USD"),
    ("NVDA", 495.80, "stock", "USD"),
    ("GOOGL", 140.30, "stock", "USD"),
    ("BTC-USD", 43500.0, "crypto", "USD"),
    ("ETH-USD", 2250.0, "crypto", "USD"),
    ("SOL-USD", 98.50, "crypto", "USD"),
    ("EUR-USD", 1.0850, "forex", "USD"),
    ("CAD-USD", 0.7420, "forex", "USD"),
]
# Bid/ask spread as a fraction of price, by asset type.
SPREAD_PCT = {"stock": 0.0002, "crypto": 0.0005, "forex": 0.00015}
# Price precision (decimal places) by asset type; everything else uses 2.
PRICE_DECIMALS = {"forex": 4}
DEFAULT_PRICE_DECIMALS = 2
# Valid close-price range per symbol, both ends inclusive.
MARKET_PRICE_RANGES = [
    ("AAPL", 1.0, 500000.0),
    ("TSLA", 1.0, 500000.0),
    ("MSFT", 1.0, 500000.0),
    ("NVDA", 1.0, 500000.0),
    ("GOOGL", 1.0, 500000.0),
    ("BTC-USD", 1.0, 50000000.0),
    ("ETH-USD", 1.0, 5000000.0),
    ("SOL-USD", 1.0, 500000.0),
    ("EUR-USD", 0.01, 100.0),
    ("CAD-USD", 0.01, 100.0),
]
# Alert thresholds on returns_pct (strict bounds).
ALERT_PCT = 3.0
CRITICAL_PCT = 8.0
# Tick anomaly threshold on the unscaled return (strict bound).
ANOMALY_RETURN = 0.03
# Risk levels on the mean alert rate (strict bounds).
HIGH_RISK_PCT = 10.0
MEDIUM_RISK_PCT = 5.0
# Trading periods per year used to annualise realized volatility.
PERIODS_PER_YEAR = 252
# Check detail messages (reference wording; {} are the counts).
CHECK_MESSAGES = {
    "data_freshness": "{} fenêtres récentes trouvées",
    "price_range_validity": "{} prix hors plage détectés",
    "positive_volume": "{} volumes invalides",
    "ohlc_consistency": "{} OHLC incohérents",
    "symbol_coverage": "{}/{} symboles couverts",
}

# ---------------------------------------------------------------------------
# Test-tick mapping over the driver's `events` table (see FIXTURES.md §3)
# ---------------------------------------------------------------------------
EVENT_ASSETS = [
    ("click", 100.0, "stock", "USD"),
    ("error", 100.0, "forex", "USD"),
    ("purchase", 100.0, "crypto", "USD"),
    ("signup", 100.0, "crypto", "USD"),
    ("view", 100.0, "stock", "USD"),
]
EVENT_PRICE_RANGES = [
    ("click", 100.0, 105.0),
    ("error", 1.0, 500000.0),
    ("purchase", 1.0, 500000.0),
    ("signup", 1.0, 500000.0),
    ("view", 1.0, 500000.0),
]
