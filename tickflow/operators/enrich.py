"""Enrichment of window stats by the static dimension (inner join on symbol)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.functions.prices import label_status, price_range_pct, round_columns
from tickflow.schema import ANOMALY_THRESHOLD, ENRICHED_COLUMNS

# Broadcast the dimension only while it has at most this many rows and bytes
# of text; past either the join falls back to a shuffle join.
BROADCAST_MAX_ROWS = 100_000
BROADCAST_MAX_BYTES = 32 << 20

DIMENSION_COLUMNS = ["symbol", "full_name", "market_cap_tier", "sector", "launched_year"]


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Proven size bound: reads at most ``max_rows + 1`` rows to decide."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))
    rows, text = df.limit(max_rows + 1).agg(F.count(F.lit(1)), size).first()
    return rows <= max_rows and (text or 0) <= max_bytes


def dimension_side(meta: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Projected dimension, hinted for broadcast when its row count is bounded."""
    small = meta.select(*DIMENSION_COLUMNS)
    return F.broadcast(small) if has_at_most(small, max_rows) else small


def enrich(
    stats: DataFrame,
    meta: DataFrame,
    threshold: float = ANOMALY_THRESHOLD,
    price_digits: int = 4,
    pct_digits: int = 6,
    broadcast_max_rows: int | None = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Window stats joined to the dimension, with range pct and status.

    Order of steps matters and follows the upstream job: the range pct is
    computed from the unrounded prices and rounded to ``pct_digits``; the
    status compares that rounded pct; only then are prices and volume rounded
    to ``price_digits``.  Symbols missing from the dimension are dropped.
    ``broadcast_max_rows=None`` takes ``meta`` as already prepared by
    ``dimension_side`` (streams decide once, not per micro-batch).
    """
    side = meta if broadcast_max_rows is None else dimension_side(meta, broadcast_max_rows)
    # Null-safe, so that no filter of the join reaches the aggregation below: where the plain
    # statistics are stored too, both share one scan and one exchange.  The side has no null symbol.
    known = side.where(F.col("symbol").isNotNull()).withColumnRenamed("symbol", "_symbol")
    joined = stats.join(known, F.col("symbol").eqNullSafe(F.col("_symbol")), "inner").drop("_symbol")
    out = joined.withColumn("price_range_pct", price_range_pct(digits=pct_digits)).withColumn(
        "status", label_status(threshold=threshold)
    )
    out = round_columns(out, ["avg_price", "min_price", "max_price", "total_volume"], price_digits)
    return out.select(*ENRICHED_COLUMNS)
