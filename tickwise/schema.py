"""Feed schema, column names and label domains."""

from pyspark.sql import types as T

# The 24-hour ticker fields the engine reads, in feed order.
FEED_FIELDS = [
    "symbol", "lastPrice", "priceChangePercent", "volume", "bidPrice",
    "askPrice", "openPrice", "highPrice", "lowPrice", "quoteVolume",
]

# Explicit all-string schema: the feed sends numbers as strings, and a fixed
# schema removes the JSON inference pass over every snapshot.
RAW = T.StructType([T.StructField(f, T.StringType(), True) for f in FEED_FIELDS])

NUMERIC_FEED = FEED_FIELDS[1:]

# Profile A renames the numeric feed fields to snake_case.
SNAKE = {
    "lastPrice": "last_price",
    "priceChangePercent": "price_change_percent",
    "volume": "volume",
    "bidPrice": "bid_price",
    "askPrice": "ask_price",
    "openPrice": "open_price",
    "highPrice": "high_price",
    "lowPrice": "low_price",
    "quoteVolume": "quote_volume",
}

# Label domains of the binned (categorical) profile B columns,
# in bin order. Zero-filled distributions list every one of them.
RISK_LABELS_B = ["LOW", "MEDIUM", "HIGH", "VERY_HIGH"]
ANOMALY_LABELS_B = ["NORMAL", "LOW", "MODERATE", "HIGH", "CRITICAL"]

# Columns shown by the detail table of the dashboard.
DISPLAY_COLUMNS = [
    "symbol", "last_price", "price_change_percent", "volume_usd",
    "risk_category", "trading_signal", "anomaly_level", "recommendation",
]

# Summary source tags.
SOURCE_TAG_A = "spark_etl_pipeline"
SOURCE_TAG_B = "relative_profile"

# Every label each ladder can emit, per profile.
LABELS_A = {
    "risk_category": ["LOW", "MEDIUM", "HIGH", "VERY_HIGH"],
    "trading_signal": ["STRONG_BUY", "BUY", "STRONG_SELL", "SELL", "HOLD"],
    "anomaly_level": ["CRITICAL", "HIGH", "MODERATE", "LOW", "NORMAL"],
    "recommendation": ["AVOID", "EXTREME_CAUTION", "INVESTIGATE", "BUY_RECOMMENDED",
                       "SELL_RECOMMENDED", "ARBITRAGE_OPPORTUNITY", "CAUTION", "MONITOR"],
}
LABELS_B = {
    "risk_category": RISK_LABELS_B,
    "trading_signal": ["HOLD", "STRONG_BUY", "BUY", "STRONG_SELL", "SELL"],
    "anomaly_level": ANOMALY_LABELS_B,
    "recommendation": ["MONITOR", "AVOID", "BUY_RECOMMENDED", "SELL_RECOMMENDED", "CAUTION"],
}
# profile B's binned columns list every label, zero counts included
ZERO_FILLED_B = ["risk_category", "anomaly_level"]

# Landed snapshot naming, <prefix><stamp>.json, where the stamp
# is %Y-%m-%d_%H-%M-%S or %Y%m%d_%H%M%S (both occur in one folder).
SNAPSHOT_PREFIX = "ticker_"
SNAPSHOT_GLOB = SNAPSHOT_PREFIX + "*.json"
