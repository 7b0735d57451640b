"""Event-time window aggregations per symbol.

The same function serves a batch frame and a streaming frame.  On a stream
the watermark bounds the state; on a batch it is not applied (it would only be
ignored, and batch time columns are ``timestamp_ntz``, which watermarks
reject).  Every aggregate here is algebraic, so Spark runs a partial (map-side)
aggregate before the shuffle: a symbol holding a third of all ticks costs one
partial row per task, not a third of the data in one task.
"""

from __future__ import annotations

import math
import re
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.functions.prices import flag_anomaly, price_range_pct
from tickflow.schema import ANOMALY_THRESHOLD

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def interval_micros(text: str) -> int:
    """``"2 minutes"`` -> 120000000 (the units ``F.window`` accepts; fractions as of ``"0.5 seconds"`` too)."""
    number = r"\d+(?:\.\d+)?"
    if not re.fullmatch(rf"(?:\s*{number}\s*[a-zA-Z]+)+\s*", text):
        raise ValueError(f"not a window duration: {text!r}")
    total = Fraction(0)
    for num, unit in re.findall(rf"({number})\s*([a-zA-Z]+)", text):
        u = unit.lower().rstrip("s")
        if u not in _UNIT_MICROS:
            raise ValueError(f"unsupported unit {unit!r} in {text!r}")
        total += Fraction(num) * _UNIT_MICROS[u]
    if total.denominator != 1:
        raise ValueError(f"{text!r} is not a whole number of microseconds")
    return int(total)


def _watermarked(df: DataFrame, time_col: str, watermark: str | None) -> DataFrame:
    if watermark and df.isStreaming:
        return df.withWatermark(time_col, watermark)
    return df


def _flat_window(extra: list[str]) -> list:
    return [
        F.col("symbol"),
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[F.col(c) for c in extra],
    ]


def window_stats(
    df: DataFrame,
    width: str = "30 seconds",
    watermark: str | None = "1 minute",
    time_col: str = "timestamp",
    stamp: bool = False,
    count: bool = False,
) -> DataFrame:
    """Tumbling windows: avg/min/max price and summed quantity per symbol.

    ``stamp`` adds ``updated_at`` = latest tick time in the window, a
    deterministic stand-in for the write time of the stored table; ``count``
    adds ``n_ticks``, the ticks that the window holds.
    """
    src = _watermarked(df, time_col, watermark)
    aggs = [
        F.avg("price").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum("quantity").alias("total_volume"),
    ]
    cols = ["avg_price", "min_price", "max_price", "total_volume"]
    if stamp:
        aggs.append(F.max(time_col).alias("updated_at"))
        cols.append("updated_at")
    if count:
        aggs.append(F.count(F.lit(1)).alias("n_ticks"))
        cols.append("n_ticks")
    out = src.groupBy(F.window(time_col, width).alias("window"), F.col("symbol")).agg(*aggs)
    return out.select(*_flat_window(cols))


def moving_average(
    df: DataFrame,
    width: str = "2 minutes",
    slide: str = "30 seconds",
    watermark: str | None = "3 minutes",
    time_col: str = "timestamp",
    stamp: bool = False,
    method: str = "auto",
) -> DataFrame:
    """Sliding windows: mean price and summed quantity per symbol.

    ``method="window"`` is ``F.window(ts, width, slide)``: every tick is copied
    into width/slide windows before aggregating.  ``method="panes"`` (the batch
    default when width is a multiple of slide) aggregates each tick once into a
    slide-wide pane, then combines width/slide panes per window -- the copy is
    made of pane sums, not of ticks.  Streams always use ``window`` (one
    stateful aggregate keeps update mode).
    """
    width_us, slide_us = interval_micros(width), interval_micros(slide)
    use_panes = method == "panes" or (
        method == "auto" and not df.isStreaming and width_us % slide_us == 0 and width_us > slide_us
    )
    if method == "panes" and (df.isStreaming or width_us % slide_us):
        raise ValueError("panes need a batch frame and width a multiple of slide")
    if not use_panes:
        src = _watermarked(df, time_col, watermark)
        aggs = [F.avg("price").alias("moving_avg_price"), F.sum("quantity").alias("total_volume")]
        cols = ["moving_avg_price", "total_volume"]
        if stamp:
            aggs.append(F.max(time_col).alias("updated_at"))
            cols.append("updated_at")
        out = src.groupBy(F.window(time_col, width, slide).alias("window"), F.col("symbol")).agg(*aggs)
        return out.select(*_flat_window(cols))

    panes = tick_panes(df, slide, time_col=time_col, stamp=stamp, extremes=False)
    return moving_average_from_panes(panes, slide, width, slide)


def range_anomalies(
    df: DataFrame,
    width: str = "1 minute",
    watermark: str | None = "2 minutes",
    threshold: float = ANOMALY_THRESHOLD,
    time_col: str = "timestamp",
    stamp: bool = False,
) -> DataFrame:
    """Tumbling windows: avg/max/min, range in percent of the mean, flag.

    ``price_range_pct`` is null when the mean is 0 or null; ``is_anomaly`` is
    strictly-greater-than ``threshold`` on the unrounded value, else False.
    """
    src = _watermarked(df, time_col, watermark)
    aggs = [
        F.avg("price").alias("avg_price"),
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"),
    ]
    if stamp:
        aggs.append(F.max(time_col).alias("updated_at"))
    out = (
        src.groupBy(F.window(time_col, width).alias("window"), F.col("symbol"))
        .agg(*aggs)
        .withColumn("price_range_pct", price_range_pct())
        .withColumn("is_anomaly", flag_anomaly(threshold=threshold))
    )
    cols = [
        F.col("symbol"),
        F.col("window.start").alias("window_start"),
        "avg_price",
        "max_price",
        "min_price",
        "price_range_pct",
        "is_anomaly",
    ]
    if stamp:
        cols.append("updated_at")
    return out.select(*cols)


def baseline_price(
    df: DataFrame,
    width: str = "1 minute",
    watermark: str | None = "2 minutes",
    time_col: str = "timestamp",
) -> DataFrame:
    """Tumbling-window mean price per symbol (defined upstream, never started)."""
    src = _watermarked(df, time_col, watermark)
    out = src.groupBy(F.window(time_col, width).alias("window"), F.col("symbol")).agg(
        F.avg("price").alias("baseline_price")
    )
    return out.select(*_flat_window(["baseline_price"]))


# --- panes: aggregate every tick once, derive the windows from the panes ------------
#
# A pane is a tumbling window whose width divides every window of interest.
# One pass over the ticks gives one row per (symbol, pane) with the price sum,
# count, min and max and the summed quantity -- all algebraic, so the pass has
# a map-side partial aggregate.  Tumbling windows that are multiples of the
# pane, and sliding windows whose slide is, are then aggregates over pane rows
# (a bounded number per window), never over ticks again.


def shared_pane(*durations: str) -> str:
    """The widest pane dividing all ``durations`` (their gcd)."""
    return f"{math.gcd(*(interval_micros(d) for d in durations))} microseconds"


def tick_panes(
    df: DataFrame,
    pane: str = "30 seconds",
    time_col: str = "timestamp",
    stamp: bool = False,
    extremes: bool = True,
) -> DataFrame:
    """One row per (symbol, pane start ``_pane``): ``_psum``, ``_pcnt`` and --
    with ``extremes`` -- ``_pmin``, ``_pmax`` of price, ``_qsum`` of quantity
    (when the frame has one) and, with ``stamp``, the latest tick time
    ``_last``.  Sliding means need no extremes."""
    aggs = [F.sum("price").alias("_psum"), F.count("price").alias("_pcnt")]
    if extremes:
        aggs += [F.min("price").alias("_pmin"), F.max("price").alias("_pmax")]
    if "quantity" in df.columns:
        aggs.append(F.sum("quantity").alias("_qsum"))
    if stamp:
        aggs.append(F.max(time_col).alias("_last"))
    return df.groupBy(F.col("symbol"), F.window(time_col, pane).start.alias("_pane")).agg(*aggs)


def roll_panes(panes: DataFrame, pane: str, width: str) -> DataFrame:
    """Panes of ``pane`` -> tumbling panes of ``width`` (a multiple of it)."""
    pane_us, width_us = interval_micros(pane), interval_micros(width)
    if width_us % pane_us:
        raise ValueError(f"{width!r} is not a multiple of the pane {pane!r}")
    if width_us == pane_us:
        return panes
    merge = {"_psum": F.sum, "_pcnt": F.sum, "_pmin": F.min, "_pmax": F.max, "_qsum": F.sum, "_last": F.max}
    aggs = [fn(c).alias(c) for c, fn in merge.items() if c in panes.columns]
    return panes.groupBy(F.col("symbol"), F.window("_pane", width).start.alias("_pane")).agg(*aggs)


def _pane_mean() -> Column:
    # Spark's avg is sum / count with null for an empty count: the same value.
    return F.try_divide(F.col("_psum"), F.col("_pcnt"))


def _stamped(panes: DataFrame, cols: list) -> list:
    return cols + ([F.col("_last").alias("updated_at")] if "_last" in panes.columns else [])


def window_stats_from_panes(panes: DataFrame, pane: str, width: str = "30 seconds") -> DataFrame:
    """``window_stats`` from ``tick_panes`` rows (no shuffle when width == pane)."""
    w = roll_panes(panes, pane, width)
    cols = [
        F.col("symbol"),
        F.col("_pane").alias("window_start"),
        F.timestamp_add("MICROSECOND", F.lit(interval_micros(width)), F.col("_pane")).alias("window_end"),
        _pane_mean().alias("avg_price"),
        F.col("_pmin").alias("min_price"),
        F.col("_pmax").alias("max_price"),
        F.col("_qsum").alias("total_volume"),
    ]
    return w.select(*_stamped(w, cols))


def range_anomalies_from_panes(
    panes: DataFrame,
    pane: str,
    width: str = "1 minute",
    threshold: float = ANOMALY_THRESHOLD,
) -> DataFrame:
    """``range_anomalies`` from ``tick_panes`` rows."""
    w = roll_panes(panes, pane, width).select(
        "symbol",
        "_pane",
        _pane_mean().alias("avg_price"),
        F.col("_pmax").alias("max_price"),
        F.col("_pmin").alias("min_price"),
        *(["_last"] if "_last" in panes.columns else []),
    )
    out = w.withColumn("price_range_pct", price_range_pct()).withColumn(
        "is_anomaly", flag_anomaly(threshold=threshold)
    )
    cols = [
        F.col("symbol"),
        F.col("_pane").alias("window_start"),
        "avg_price",
        "max_price",
        "min_price",
        "price_range_pct",
        "is_anomaly",
    ]
    return out.select(*_stamped(out, cols))


def moving_average_from_panes(panes: DataFrame, pane: str, width: str, slide: str) -> DataFrame:
    """``moving_average`` from ``tick_panes`` rows: each slide-wide pane is
    copied into the width/slide windows that contain it, then summed."""
    width_us, slide_us = interval_micros(width), interval_micros(slide)
    if width_us % slide_us:
        raise ValueError("panes need width to be a multiple of slide")
    p = roll_panes(panes, pane, slide)
    k = width_us // slide_us
    # A pane starting at p lies in the windows starting at p, p - slide, ...
    offsets = F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long"))
    spread = p.withColumn("_i", F.explode(offsets)).withColumn(
        "window_start",
        F.timestamp_add("MICROSECOND", F.col("_i") * F.lit(-slide_us).cast("long"), F.col("_pane")),
    )
    win_aggs = [F.sum("_psum").alias("_psum"), F.sum("_pcnt").alias("_pcnt"), F.sum("_qsum").alias("total_volume")]
    if "_last" in p.columns:
        win_aggs.append(F.max("_last").alias("_last"))
    out = spread.groupBy("symbol", "window_start").agg(*win_aggs)
    cols = [
        F.col("symbol"),
        F.col("window_start"),
        F.timestamp_add("MICROSECOND", F.lit(width_us), F.col("window_start")).alias("window_end"),
        _pane_mean().alias("moving_avg_price"),
        F.col("total_volume"),
    ]
    return out.select(*_stamped(out, cols))
