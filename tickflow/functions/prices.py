"""Column expressions for price statistics, flags, labels and rounding."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.schema import ANOMALY_THRESHOLD


def price_range_pct(
    max_col: str = "max_price",
    min_col: str = "min_price",
    avg_col: str = "avg_price",
    digits: int | None = None,
) -> Column:
    """``(max - min) / avg * 100``; null when avg is 0 or null (no ANSI error)."""
    pct = F.try_divide(F.col(max_col) - F.col(min_col), F.col(avg_col)) * F.lit(100.0)
    return F.round(pct, digits) if digits is not None else pct


def flag_anomaly(pct_col: str = "price_range_pct", threshold: float = ANOMALY_THRESHOLD) -> Column:
    """Strictly above the threshold -> True, anything else (null too) -> False."""
    return F.when(F.col(pct_col) > F.lit(threshold), F.lit(True)).otherwise(F.lit(False))


def label_status(pct_col: str = "price_range_pct", threshold: float = ANOMALY_THRESHOLD) -> Column:
    """``ANOMALY`` strictly above the threshold, ``NORMAL`` otherwise."""
    return F.when(F.col(pct_col) > F.lit(threshold), F.lit("ANOMALY")).otherwise(F.lit("NORMAL"))


def round_columns(df: DataFrame, cols: Iterable[str], digits: int) -> DataFrame:
    """Round the named columns in place (HALF_UP, nulls pass through)."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def band(value: Column | str, steps: Sequence[tuple[float | None, str]]) -> Column:
    """Threshold bands: ``steps`` is ``[(None, base), (t1, name1), ...]``.

    A value at or above ``t_i`` takes ``name_i`` (the highest step reached wins);
    null values stay null.
    """
    v = F.col(value) if isinstance(value, str) else value
    base = steps[0][1]
    out = F.lit(base)
    for limit, name in steps[1:]:
        out = F.when(v >= F.lit(limit), F.lit(name)).otherwise(out)
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(out)
