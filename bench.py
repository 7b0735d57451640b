"""Benchmark the headline workloads; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 5, after one warm-up run), BENCH_EVENT_LOG_DIR (optional:
write Spark's event log there for stage and task times).  Each workload is executed in
full through the ``noop`` sink (nothing is collected to the driver); the value
per query is the median wall time in seconds.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tickflow.operators.store import latest_by_key  # noqa: E402
from tickflow.operators.windows import moving_average, window_stats  # noqa: E402
from tickflow.plans import registry as B  # noqa: E402
from tickflow.operators.store import upsert  # noqa: E402
from tickflow.operators.views import put_views, read_latest, read_newest  # noqa: E402
from tickflow.plans import registry_reports as RR  # noqa: E402
from tickflow.plans import reports as R  # noqa: E402
from tickflow.plans.registry_reports import KV_SPARK  # noqa: E402
from tickflow.schema import ANOMALY_KEYS, MOVING_AVG_KEYS, WINDOWED_KEYS  # noqa: E402
from tickflow.session import build_session, scratch_path  # noqa: E402
from tickflow.sources.testdata import lineitem_as_ticks, load_table  # noqa: E402
from tickflow.streaming.jobs import run_backfill, start_query, store_writer  # noqa: E402
from tickflow.streaming.replay import AVAILABLE_NOW, replay_events, run_until_done  # noqa: E402


def lineitem_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_stats(lineitem_as_ticks(load_table(spark, sf_dir, "lineitem")), "30 days")


def lineitem_moving_average_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moving_average(lineitem_as_ticks(load_table(spark, sf_dir, "lineitem")), "30 days", "1 day")


def stream_1h_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades, root = replay_events(spark, sf_dir, 5, ["symbol", "price", "quantity", "event_time"])
    q = start_query(
        window_stats(trades, "1 hour", watermark="1 minute"),
        "bench_stream",
        store_writer(f"{root}/windowed", WINDOWED_KEYS),
        f"{root}/checkpoint",
        trigger=AVAILABLE_NOW,
    )
    run_until_done(q)
    return latest_by_key(spark, f"{root}/windowed", ["symbol", "window_start"])


def backfill_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every upstream table from the raw ticks in one batch (the history case)."""
    root = scratch_path(spark, "bench-backfill")
    run_backfill(B.trades(spark, sf_dir), root, 0, meta=B.dimension_fixture(spark))
    return latest_by_key(spark, f"{root}/windowed", ["symbol", "window_start"])


_STORED: dict = {}


def _stored_tables(spark: SparkSession, sf_dir: str, since=None) -> dict:
    """Stored tables written once (as the stream would leave them), then read.

    ``since`` is the panels' range start, pushed below the merge."""
    if sf_dir not in _STORED:
        root = scratch_path(spark, "bench-stored")
        for name, build, keys in [
            ("windowed", RR.stored_windowed, WINDOWED_KEYS),
            ("moving_avg", RR.stored_moving_avg, MOVING_AVG_KEYS),
            ("anomalies", RR.stored_anomalies, ANOMALY_KEYS),
        ]:
            table = build(spark, sf_dir).persist()
            upsert(table, f"{root}/{name}", 0)
            put_views(table, f"{root}/{name}/views", 0)
            table.unpersist()
        _STORED[sf_dir] = root
    root = _STORED[sf_dir]
    return {
        "windowed": latest_by_key(spark, f"{root}/windowed", WINDOWED_KEYS, since=since),
        "moving_avg": latest_by_key(spark, f"{root}/moving_avg", MOVING_AVG_KEYS, since=since),
        "anomalies": latest_by_key(spark, f"{root}/anomalies", ANOMALY_KEYS, since=since),
    }


def all_reports(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The 17 panel queries over the stored tables (the dashboard's read path).

    Panels with a time range read the tables with the range start pushed
    below the merge; "latest" panels and the symbol list read the incremental views."""
    r = _stored_tables(spark, sf_dir, since=RR.RANGE_START)
    root = _STORED[sf_dir]
    lw, la = read_latest(spark, f"{root}/windowed/views"), read_latest(spark, f"{root}/anomalies/views")
    nw = read_newest(spark, f"{root}/windowed/views", 50)
    rw, rm, ra = r["windowed"], r["moving_avg"], r["anomalies"]
    rng = (RR.RANGE_START, RR.RANGE_END)
    return [
        R.latest_avg_price(lw), R.latest_total_volume(lw), R.anomaly_count(ra, *rng), R.latest_range_pct(la),
        R.rows_written(rw, *rng), R.freshness_seconds(lw, RR.AS_OF), R.series(rw, "avg_price", *rng),
        R.price_band(rw, *rng), R.series(rm, "moving_avg_price", *rng), R.series(rw, "total_volume", *rng),
        R.series(ra, "price_range_pct", *rng), R.anomaly_counts_by_minute(ra, *rng), R.latest_rows(nw, 50),
        R.symbol_summary(rw, *rng), R.anomaly_log(ra, *rng, n=100), R.symbols(lw),
        R.series_legend(R.series(rw, "avg_price", *rng, ordered=False)),
    ]


WORKLOADS = {
    "window_stats_30s": B.q_window_stats("30 seconds"),
    "moving_average_2m_30s": B.q_moving_average("2 minutes", "30 seconds"),
    "range_anomalies_1m": B.q_range_anomalies("1 minute", 0.5),
    "enriched_stats_1h": B.q_enriched_stats_1h,
    "stream_window_stats_1h_upsert": stream_1h_upsert,
    "lineitem_window_stats_30d": lineitem_30d,
    "lineitem_moving_average_30d_1d": lineitem_moving_average_30d,
    "kv_merge_cells": KV_SPARK["kv_merge_cells"],
    "reports_17": all_reports,
    "backfill_all_tables": backfill_all_tables,
}


def run_once(spark: SparkSession, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    out = fn(spark, sf_dir)
    for df in out if isinstance(out, list) else [out]:
        df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    only = set(sys.argv[1:])
    extra = {}
    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    if log_dir:  # stage/task times without the UI: Spark's event log in a scratch folder
        os.makedirs(log_dir, exist_ok=True)
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
    spark = build_session(f"local[{cpus}]", app_name="tickflow-bench", shuffle_partitions=cpus, extra=extra)
    results = {}
    for name, fn in WORKLOADS.items():
        if only and name not in only:
            continue
        run_once(spark, fn, sf_dir)  # warm-up
        results[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(runs)), 4)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "median_seconds_total",
                "value": round(sum(results.values()), 4),
                "unit": "sec",
                "queries": results,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
