"""Fixed schemas and the fixed dimension rows.

Everything here is a value that has to equal the upstream application's for
results to line up: the trade message layout, the result-table columns, the
dimension rows and the key-value cell names.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: trade message (JSON) ------------------------------------
TRADE = T.StructType(
    [
        T.StructField("event_type", T.StringType(), True),
        T.StructField("event_time", T.LongType(), True),
        T.StructField("symbol", T.StringType(), True),
        T.StructField("trade_id", T.LongType(), True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("quantity", T.DoubleType(), True),
        T.StructField("buyer_maker", T.BooleanType(), True),
        T.StructField("trade_time", T.LongType(), True),
    ]
)

# --- fixed values: static dimension ----------------------------------------
METADATA = T.StructType(
    [
        T.StructField("symbol", T.StringType(), True),
        T.StructField("full_name", T.StringType(), True),
        T.StructField("market_cap_tier", T.StringType(), True),
        T.StructField("sector", T.StringType(), True),
        T.StructField("country_of_origin", T.StringType(), True),
        T.StructField("launched_year", T.IntegerType(), True),
    ]
)

# Column order of the enriched output (country_of_origin is dropped).
ENRICHED_COLUMNS = [
    "symbol",
    "full_name",
    "market_cap_tier",
    "sector",
    "launched_year",
    "window_start",
    "window_end",
    "avg_price",
    "min_price",
    "max_price",
    "total_volume",
    "price_range_pct",
    "status",
]

# Stored (relational) result tables: columns and primary keys.
WINDOWED_KEYS = ["symbol", "window_start"]
MOVING_AVG_KEYS = ["symbol", "window_start", "window_end"]
ANOMALY_KEYS = ["symbol", "window_start"]

# --- fixed values: key-value cells (family:qualifier -> result column) ------
KV_WINDOWED_CELLS = {
    "price:avg": "avg_price",
    "price:min": "min_price",
    "price:max": "max_price",
    "volume:total": "total_volume",
}
KV_MOVING_AVG_CELLS = {
    "price:moving_avg": "moving_avg_price",
    "volume:total": "total_volume",
}
KV_ANOMALY_CELLS = {
    "price:avg": "avg_price",
    "price:max": "max_price",
    "price:min": "min_price",
    "alert:price_range_pct": "price_range_pct",
    "alert:is_anomaly": "is_anomaly",
}
KV_ENRICHED_CELLS = {
    "price:avg": "avg_price",
    "price:min": "min_price",
    "price:max": "max_price",
    "price:range_pct": "price_range_pct",
    "price:status": "status",
    "volume:total": "total_volume",
    "price:full_name": "full_name",
    "price:tier": "market_cap_tier",
    "price:sector": "sector",
    "price:launched": "launched_year",
}

# Row-key timestamp rendering: space separator, no "T", whole seconds.
ROW_KEY_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Anomaly threshold in percent; comparisons are strict (>).
ANOMALY_THRESHOLD = 0.5

# Freshness bands in seconds: green below 30, yellow from 30, red from 90.
FRESHNESS_BANDS = [(None, "green"), (30.0, "yellow"), (90.0, "red")]
# Anomaly-count bands: green below 1, red from 1.
ANOMALY_COUNT_BANDS = [(None, "green"), (1.0, "red")]
