"""Structured Streaming: foreachBatch upserts and console."""

from tickflow.streaming.jobs import (
    dbapi_writer,
    enriched_writer,
    fan_out,
    kv_writer,
    run_streams,
    split_writer,
    start_console,
    start_console_jobs,
    start_enriched_job,
    start_query,
    start_tick_jobs,
    store_writer,
)
from tickflow.streaming.watch import TickAccount, counted_input, open_windows, run_together

__all__ = [
    "TickAccount",
    "counted_input",
    "dbapi_writer",
    "enriched_writer",
    "fan_out",
    "kv_writer",
    "open_windows",
    "run_streams",
    "run_together",
    "split_writer",
    "start_console",
    "start_console_jobs",
    "start_enriched_job",
    "start_query",
    "start_tick_jobs",
    "store_writer",
]
