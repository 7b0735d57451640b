"""Time conversions that do not depend on the session time zone.

Batch queries keep ``timestamp_ntz`` (wall clock in UTC); streaming needs a
``timestamp`` column for watermarks.  Converting through epoch numbers keeps
both exact whatever ``spark.sql.session.timeZone`` is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_from_epoch_ms(ms: Column | str) -> Column:
    """Epoch milliseconds -> ``timestamp_ntz`` in UTC."""
    return F.timestamp_add("MILLISECOND", _col(ms), epoch_ntz())


def epoch_ms_of_ntz(ts: Column | str) -> Column:
    """``timestamp_ntz`` -> epoch milliseconds, truncated (like ``int(t*1000)``)."""
    return F.timestamp_diff("MILLISECOND", epoch_ntz(), _col(ts))


def ntz_from_ltz(ts: Column | str) -> Column:
    """``timestamp`` (an instant) -> the UTC wall clock as ``timestamp_ntz``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), epoch_ntz())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
