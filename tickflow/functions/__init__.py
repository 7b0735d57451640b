"""Column-level helpers (all JVM-side built-in expressions)."""

from tickflow.functions.keys import key_time, normalize_symbol, row_key
from tickflow.functions.prices import (
    band,
    flag_anomaly,
    label_status,
    price_range_pct,
    round_columns,
)
from tickflow.functions.time import (
    epoch_ms_of_ntz,
    epoch_ntz,
    ntz_from_epoch_ms,
    ntz_from_ltz,
)

__all__ = [
    "band",
    "epoch_ms_of_ntz",
    "epoch_ntz",
    "flag_anomaly",
    "key_time",
    "label_status",
    "normalize_symbol",
    "ntz_from_epoch_ms",
    "ntz_from_ltz",
    "price_range_pct",
    "round_columns",
    "row_key",
]
