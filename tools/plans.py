"""Write PLANS.md: the physical plans of the headline queries, for review.

Usage: python tools/plans.py [sf_dir]   (default /root/testdata/sf0.1)
AQE is switched off here only so the printed plans are the full static plans
(AQE re-plans at run time and would print an unfinished plan).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickflow.operators.kv import read_kv, scan_prefix  # noqa: E402
from tickflow.plans import registry as B  # noqa: E402
from tickflow.plans import reports as R  # noqa: E402
from tickflow.plans.registry_reports import stored_windowed  # noqa: E402
from tickflow.session import build_session  # noqa: E402

NOTES = {
    "window_stats_30s": "One scan (5 of 6 columns), JSON parsed once inside `Generate inline(...)`, "
    "partial aggregate before the only shuffle, final aggregate after it.",
    "moving_average_2m_30s": "Panes: partial+final aggregate per (symbol, 30 s pane), then `Generate explode` "
    "of pane sums into 4 windows and a second (small) aggregate. No per-tick `Expand`.",
    "enriched_stats_1h": "Dimension behind a proven row bound -> `BroadcastHashJoin`; the stats side is not "
    "shuffled for the join.",
    "latest_avg_price": "Latest per symbol is `max_by(struct, (updated_at, window_start))` with a partial "
    "step before the shuffle: a hot symbol costs one partial row per task, never a third of the data in one "
    "task. A struct buffer is not fixed-width, so Spark runs it as `SortAggregate` (a spillable local sort "
    "per task) rather than a hash aggregate; the input is the stored aggregate table, not raw ticks.",
    "latest_rows": "Top-50 report: `TakeOrderedAndProject` (per-task top-N, then merge), no global sort.",
    "kv_prefix_scan": "`StringStartsWith(row_key, ...)` reaches `PushedFilters` of the parquet scan, below the "
    "cell merge; files are sorted by row_key so row-group statistics prune.",
    "backfill_tick_panes": "The backfill's only pass over raw ticks: one scan, JSON parsed once, partial "
    "aggregate per (symbol, 30 s pane) before the only shuffle. The three upstream tables are derived from "
    "this (written) pane table.",
    "backfill_anomalies_from_panes": "1 min anomalies from the written pane table: pane rows, not ticks, "
    "are shuffled (partial aggregate first).",
    "stored_range_panel": "A range panel over the stored table: the range start (`updated_at >= ...`) is in "
    "`PushedFilters` of the log scan, below the `max_by` merge; the range end is applied after it.",
    "view_latest_avg_price": "A latest panel read from the incremental view (one candidate row per symbol "
    "per batch), not from the table's history.",
}


def _store_frames(spark, sf_dir: str) -> dict:
    from tickflow.operators.store import latest_by_key, upsert
    from tickflow.operators.views import put_views, read_latest
    from tickflow.operators.windows import range_anomalies_from_panes, tick_panes
    from tickflow.plans.registry_reports import RANGE_END, RANGE_START
    from tickflow.schema import WINDOWED_KEYS
    from tickflow.session import scratch_path

    root = scratch_path(spark, "plans")
    panes = tick_panes(B.trades(spark, sf_dir), "30 seconds")
    panes.write.parquet(f"{root}/panes")
    table = stored_windowed(spark, sf_dir)
    upsert(table, f"{root}/windowed", 0)
    put_views(table, f"{root}/windowed/views", 0)
    stored = latest_by_key(spark, f"{root}/windowed", WINDOWED_KEYS, since=RANGE_START)
    return {
        "backfill_tick_panes": panes,
        "backfill_anomalies_from_panes": range_anomalies_from_panes(
            spark.read.parquet(f"{root}/panes"), "30 seconds", "1 minute"
        ),
        "stored_range_panel": R.series(stored, "avg_price", RANGE_START, RANGE_END),
        "view_latest_avg_price": R.latest_avg_price(read_latest(spark, f"{root}/windowed/views")),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16, extra={"spark.sql.adaptive.enabled": "false"})
    frames = {
        "window_stats_30s": B.q_window_stats("30 seconds")(spark, sf_dir),
        "moving_average_2m_30s": B.q_moving_average("2 minutes", "30 seconds")(spark, sf_dir),
        "enriched_stats_1h": B.q_enriched_stats_1h(spark, sf_dir),
        "latest_avg_price": R.latest_avg_price(stored_windowed(spark, sf_dir)),
        "latest_rows": R.latest_rows(stored_windowed(spark, sf_dir), 50),
    }
    frames.update(_store_frames(spark, sf_dir))
    kv_path = sys.argv[2] if len(sys.argv) > 2 else None
    if kv_path:
        frames["kv_prefix_scan"] = scan_prefix(read_kv(spark, kv_path), "click")
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/plans.py` on `{sf_dir}` (AQE off for a static plan).", ""]
    for name, df in frames.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = [ln if len(ln) <= 160 else ln[:157] + "..." for ln in plan.splitlines()]
        out += [f"## {name}", "", NOTES.get(name, ""), "", "```", *lines, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
