"""Report queries over the stored result tables (panel and dashboard reads).

Inputs are the stored tables as DataFrames: ``windowed`` (symbol,
window_start, window_end, avg_price, min_price, max_price, total_volume,
updated_at), ``moving_avg`` and ``anomalies``; or the key-value table for the
scan reports.  ``now()`` and the dashboard time range are explicit parameters
(``as_of``, ``start``, ``end``) so results are reproducible.

"Latest per symbol" is a ``max_by`` aggregate (partial per task, then one row
per symbol), not a window over a per-symbol partition, so a symbol holding a
third of all rows never lands whole in one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.functions.prices import band
from tickflow.operators.kv import (
    decode_kv_anomalies,
    decode_kv_moving_avg,
    decode_kv_windowed,
    scan_prefix,
)
from tickflow.schema import ANOMALY_COUNT_BANDS, FRESHNESS_BANDS

TimeLike = dt.datetime | str


def _ts(value: TimeLike) -> Column:
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp_ntz")


# --- filters -------------------------------------------------------------------------


def for_symbols(df: DataFrame, symbols: Sequence[str] | None) -> DataFrame:
    """``symbol IN (...)``; ``None`` is the dashboard's "All"."""
    return df if symbols is None else df.where(F.col("symbol").isin(list(symbols)))


def in_range(df: DataFrame, col: str, start: TimeLike | None, end: TimeLike | None) -> DataFrame:
    """Inclusive time range on ``col`` (either bound may be open)."""
    if start is not None:
        df = df.where(F.col(col) >= _ts(start))
    if end is not None:
        df = df.where(F.col(col) <= _ts(end))
    return df


def latest_per_symbol(
    df: DataFrame,
    cols: Sequence[str],
    order: Sequence[str] = ("updated_at", "window_start"),
) -> DataFrame:
    """One row per symbol: the newest by ``updated_at``, ties to the later window."""
    packed = F.struct(*[F.col(c) for c in cols if c != "symbol"])
    key = F.struct(*[F.col(c) for c in order])
    return df.groupBy("symbol").agg(F.max_by(packed, key).alias("_r")).select("symbol", "_r.*")


# --- stat panels ----------------------------------------------------------------------


def latest_avg_price(windowed: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """Latest average price of each symbol."""
    latest = latest_per_symbol(for_symbols(windowed, symbols), ["avg_price"])
    return latest.select("symbol", "avg_price").orderBy("symbol")


def latest_total_volume(windowed: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """R2: sum over symbols of the latest window's volume; 0.0 when empty."""
    latest = latest_per_symbol(for_symbols(windowed, symbols), ["total_volume"])
    return latest.agg(
        F.coalesce(F.sum("total_volume"), F.lit(0.0)).cast("double").alias("latest_volume")
    )


def anomaly_count(
    anomalies: DataFrame, start: TimeLike, end: TimeLike, symbols: Sequence[str] | None = None
) -> DataFrame:
    """Anomalous rows written in the range (with the panel's colour band)."""
    rows = for_symbols(in_range(anomalies, "updated_at", start, end), symbols).where(F.col("is_anomaly"))
    out = rows.agg(F.count(F.lit(1)).cast("double").alias("anomalies"))
    return out.withColumn("band", band("anomalies", ANOMALY_COUNT_BANDS))


def latest_range_pct(anomalies: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """Largest latest range pct over symbols; 0.0 when empty."""
    latest = latest_per_symbol(for_symbols(anomalies, symbols), ["price_range_pct"])
    return latest.agg(
        F.coalesce(F.max("price_range_pct"), F.lit(0.0)).cast("double").alias("price_range_pct")
    )


def rows_written(windowed: DataFrame, start: TimeLike, end: TimeLike, symbols: Sequence[str] | None = None) -> DataFrame:
    """Windowed rows written in the range."""
    rows = for_symbols(in_range(windowed, "updated_at", start, end), symbols)
    return rows.agg(F.count(F.lit(1)).cast("double").alias("rows_written"))


def freshness_seconds(windowed: DataFrame, as_of: TimeLike, symbols: Sequence[str] | None = None) -> DataFrame:
    """Seconds since the last write (null when empty) and its band."""
    last = for_symbols(windowed, symbols).agg(F.max("updated_at").alias("_last"))
    secs = (F.timestamp_diff("MICROSECOND", F.col("_last"), _ts(as_of)) / F.lit(1e6)).cast("double")
    return last.select(secs.alias("seconds_since_update")).withColumn(
        "band", band("seconds_since_update", FRESHNESS_BANDS)
    )


# --- time series ----------------------------------------------------------------------


def series(
    df: DataFrame,
    value_col: str,
    start: TimeLike,
    end: TimeLike,
    symbols: Sequence[str] | None = None,
    ordered: bool = True,
) -> DataFrame:
    """``(time, metric, value)`` rows in the range, ordered unless a reducer follows.

    Rows written by one micro-batch share ``updated_at``; ``window_start`` is a
    hidden last sort key so the range partitioner can split such ties instead
    of sending a whole backfill of one symbol to one task.
    """
    rows = for_symbols(in_range(df, "updated_at", start, end), symbols)
    if ordered:
        rows = rows.orderBy("updated_at", "symbol", "window_start")
    return rows.select(
        F.col("updated_at").alias("time"),
        F.col("symbol").alias("metric"),
        F.col(value_col).alias("value"),
    )


def price_band(windowed: DataFrame, start: TimeLike, end: TimeLike, symbols: Sequence[str] | None = None) -> DataFrame:
    """Min and max series in long form from a single scan (unpivot)."""
    rows = for_symbols(in_range(windowed, "updated_at", start, end), symbols)
    long = rows.select(
        F.col("updated_at").alias("time"),
        "symbol",
        "window_start",
        F.explode(
            F.array(
                F.struct(F.lit(" min").alias("suffix"), F.col("min_price").alias("value")),
                F.struct(F.lit(" max").alias("suffix"), F.col("max_price").alias("value")),
            )
        ).alias("_p"),
    )
    out = long.select(
        "time",
        F.concat(F.col("symbol"), F.col("_p.suffix")).alias("metric"),
        F.col("_p.value").alias("value"),
        "window_start",
    )
    return out.orderBy("time", "metric", "window_start").drop("window_start")


def anomaly_counts_by_minute(
    anomalies: DataFrame, start: TimeLike, end: TimeLike, symbols: Sequence[str] | None = None
) -> DataFrame:
    """Anomalous rows per (minute of write, symbol); no gap filling."""
    rows = for_symbols(in_range(anomalies, "updated_at", start, end), symbols).where(F.col("is_anomaly"))
    out = rows.groupBy(F.window("updated_at", "1 minute").start.alias("time"), F.col("symbol").alias("metric")).agg(
        F.count(F.lit(1)).cast("double").alias("value")
    )
    return out.orderBy("time", "metric")


def series_legend(series_df: DataFrame) -> DataFrame:
    """Per series, last non-null value, min and max (legend reducers).

    "Last" is by time; equal times resolve to the larger value.
    """
    v = F.col("value")
    return series_df.groupBy("metric").agg(
        F.max_by(v, F.when(v.isNotNull(), F.struct(F.col("time"), v))).alias("last_not_null"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )


# --- tables ------------------------------------------------------------------------------


def latest_rows(windowed: DataFrame, n: int = 50, symbols: Sequence[str] | None = None) -> DataFrame:
    """The newest ``n`` windows (no time-range filter); a top-n report."""
    rows = for_symbols(windowed, symbols)
    return rows.orderBy(F.col("updated_at").desc(), F.col("symbol"), F.col("window_start").desc()).limit(n).select(
        F.col("updated_at").alias("time"),
        "symbol",
        "avg_price",
        "min_price",
        "max_price",
        "total_volume",
        "window_start",
        "window_end",
    )


def symbol_summary(
    windowed: DataFrame, start: TimeLike, end: TimeLike, symbols: Sequence[str] | None = None, digits: int = 4
) -> DataFrame:
    """Per symbol window count, mean of window means, extremes, volume."""
    rows = for_symbols(in_range(windowed, "updated_at", start, end), symbols)
    return rows.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("windows"),
        F.round(F.avg("avg_price"), digits).alias("avg_price"),
        F.round(F.min("min_price"), digits).alias("min_price"),
        F.round(F.max("max_price"), digits).alias("max_price"),
        F.round(F.sum("total_volume"), digits).alias("total_volume"),
        F.max("updated_at").alias("last_update"),
    ).orderBy("symbol")


def anomaly_log(
    anomalies: DataFrame, start: TimeLike, end: TimeLike, n: int = 100, symbols: Sequence[str] | None = None
) -> DataFrame:
    """The newest ``n`` anomaly rows in the range (flagged or not)."""
    rows = for_symbols(in_range(anomalies, "updated_at", start, end), symbols)
    return rows.orderBy(F.col("updated_at").desc(), F.col("symbol"), F.col("window_start").desc()).limit(n).select(
        F.col("updated_at").alias("time"),
        "symbol",
        "price_range_pct",
        "is_anomaly",
        "avg_price",
        "min_price",
        "max_price",
        "window_start",
    )


def symbols(windowed: DataFrame) -> DataFrame:
    """The dashboard's symbol variable."""
    return windowed.select("symbol").distinct().orderBy("symbol")


# --- key-value scans (dashboard) ----------------------------------------------------------


def scan_windowed(kv: DataFrame, symbol: str, limit: int = 20, exact: bool = False) -> DataFrame:
    return decode_kv_windowed(scan_prefix(kv, symbol, limit, exact), symbol)


def kpi_scan(kv: DataFrame, symbol: str, limit: int = 20, exact: bool = False) -> DataFrame:
    """The last row of the key-ascending scan (as upstream: the newest of
    the *oldest* ``limit`` windows, not the newest window)."""
    rows = scan_windowed(kv, symbol, limit, exact)
    cols = ["window", "avg_price", "min_price", "max_price", "total_volume"]
    return rows.agg(F.max_by(F.struct(*cols), F.col("row_key")).alias("_r")).select("_r.*").where(
        F.col("window").isNotNull()
    )


def kpi_latest(kv: DataFrame, symbol: str) -> DataFrame:
    """R17, corrected: the newest window of ``symbol`` in the key-value table.

    Exact prefix (``symbol_``), no scan limit; one partial ``max_by`` per task,
    so the whole key range never meets in one task.
    """
    rows = decode_kv_windowed(kv.where(F.col("row_key").startswith(symbol + "_")), symbol)
    cols = ["window", "avg_price", "min_price", "max_price", "total_volume"]
    return rows.agg(F.max_by(F.struct(*cols), F.col("row_key")).alias("_r")).select("_r.*").where(
        F.col("window").isNotNull()
    )


def scan_anomaly_count(kv: DataFrame, symbol: str, limit: int = 20, exact: bool = False) -> DataFrame:
    """Rows of the anomaly scan whose flag text is ``True``."""
    rows = decode_kv_anomalies(scan_prefix(kv, symbol, limit, exact), symbol)
    return rows.agg(F.count_if(F.col("is_anomaly") == F.lit("True")).alias("anomaly_count"))


def scan_moving_avg(kv: DataFrame, symbol: str, limit: int = 20, exact: bool = False) -> DataFrame:
    """Moving-average chart data, first row per window label in scan order."""
    rows = decode_kv_moving_avg(scan_prefix(kv, symbol, limit, exact), symbol)
    first = rows.groupBy("window").agg(
        F.min_by(F.struct("moving_avg_price", "total_volume"), F.col("row_key")).alias("_r")
    )
    return first.select("window", "_r.moving_avg_price", "_r.total_volume").orderBy("window")


def scan_prices(kv: DataFrame, symbol: str, limit: int = 20, exact: bool = False) -> DataFrame:
    """Price chart data (window label, avg, min, max) in scan order."""
    return scan_windowed(kv, symbol, limit, exact).orderBy("row_key").select(
        "window", "avg_price", "min_price", "max_price"
    )
