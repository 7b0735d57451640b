"""tickflow: price-tick analytics on Spark.

Decode JSON trade messages, compute per-symbol window statistics, moving
averages and range anomalies with event-time watermarks, enrich them with a
static dimension, keep results in idempotent keyed tables fed by Structured
Streaming, and answer report queries over those tables.
"""

__version__ = "0.1.0"
