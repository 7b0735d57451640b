"""Symbol and row-key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickflow.schema import ROW_KEY_TIME_FORMAT


def normalize_symbol(col: Column | str) -> Column:
    """``BTC-USD`` -> ``BTCUSD`` (every dash removed)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.replace(c, F.lit("-"), F.lit(""))


def key_time(col: Column | str) -> Column:
    """Row-key rendering of a window bound: ``yyyy-MM-dd HH:mm:ss``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, ROW_KEY_TIME_FORMAT)


def row_key(*parts: Column | str) -> Column:
    """``symbol_start`` or ``symbol_start_end``: parts joined by ``_``; a null part stays, as ``None``."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws("_", *[F.coalesce(c.cast("string"), F.lit("None")) for c in columns])
