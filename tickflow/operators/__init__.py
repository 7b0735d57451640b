"""DataFrame operators: windows, enrichment, keyed store, key-value cells."""

from tickflow.operators.enrich import dimension_side, enrich
from tickflow.operators.kv import (
    fold_kv,
    merge_cells,
    put_kv,
    read_kv,
    scan_prefix,
    to_kv_anomalies,
    to_kv_enriched,
    to_kv_moving_avg,
    to_kv_windowed,
)
from tickflow.operators.store import fold, latest_by_key, upsert, upsert_dbapi
from tickflow.operators.windows import (
    baseline_price,
    moving_average,
    range_anomalies,
    window_stats,
)

__all__ = [
    "baseline_price",
    "fold",
    "fold_kv",
    "dimension_side",
    "enrich",
    "latest_by_key",
    "merge_cells",
    "moving_average",
    "put_kv",
    "range_anomalies",
    "read_kv",
    "scan_prefix",
    "to_kv_anomalies",
    "to_kv_enriched",
    "to_kv_moving_avg",
    "to_kv_windowed",
    "upsert",
    "upsert_dbapi",
    "window_stats",
]
