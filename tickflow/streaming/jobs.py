"""Structured Streaming jobs: keyed upserts fed by update-mode aggregations.

``start_query`` wraps a writer in ``foreachBatch``: the micro-batch is
persisted and counted once (every writer reuses both), empty batches are
skipped, and writer errors propagate -- Spark then fails the query instead of
committing the offsets, and the idempotent writers make the retry safe.  Each
query has its own checkpoint folder under the shared work folder, so a
restarted driver or lost executors resume from the last commit; the id that
Spark keeps there is the epoch of the query's writes, so a query started from a
new checkpoint never meets the batches of the old one.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickflow.functions.time import ntz_from_epoch_ms, ntz_from_ltz
from tickflow.operators.enrich import DIMENSION_COLUMNS, dimension_side, enrich
from tickflow.operators.kv import fold_kv, put_kv, to_kv_anomalies, to_kv_enriched, to_kv_moving_avg, to_kv_windowed
from tickflow.operators.store import _delete, _exists, _read_text, fold, upsert, upsert_dbapi, writing_epoch
from tickflow.operators.views import fold_views, put_views
from tickflow.operators.windows import (
    moving_average,
    moving_average_from_panes,
    range_anomalies,
    range_anomalies_from_panes,
    shared_pane,
    tick_panes,
    window_stats,
    window_stats_from_panes,
)
from tickflow.sources.codec import split_bad

Writer = Callable[[DataFrame, int], None]

# AQE is off in streaming, so a micro-batch result has one partition per
# shuffle partition; without resizing, every batch would write that many tiny
# files.  Writers deal out about this many rows per file.
ROWS_PER_FILE = 250_000

_ROWS: ContextVar[int | None] = ContextVar("rows", default=None)


def file_count(df: DataFrame, rows: int | None = None) -> int:
    """Files of ~``ROWS_PER_FILE`` rows that a (persisted) micro-batch result is dealt into.

    ``rows``: the number of rows; by default that of the running micro-batch,
    which ``start_query`` counted once.  The writers deal by ranges of day and
    key: each file gets a narrow part, so file statistics prune, and a
    recomputed task deals its rows to the same files.
    """
    rows = rows if rows is not None else _ROWS.get()
    if rows is None:
        rows = df.count()
    return max(1, -(-rows // ROWS_PER_FILE))


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark wrote into a query's checkpoint when it was new."""
    return json.loads(_read_text(spark, f"{checkpoint}/metadata"))["id"]


def start_query(
    df: DataFrame,
    name: str,
    writer: Writer,
    checkpoint: str,
    output_mode: str = "update",
    trigger: dict | None = None,
    skip_empty: bool = True,
) -> StreamingQuery:
    """Start ``df`` with ``writer`` called once per non-empty micro-batch."""

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        counted = _ROWS.set(batch.count())
        try:
            if skip_empty and not _ROWS.get():
                return
            with writing_epoch(checkpoint_id(batch.sparkSession, checkpoint)):
                writer(batch, batch_id)
        finally:
            _ROWS.reset(counted)
            batch.unpersist()

    w = (
        df.writeStream.outputMode(output_mode)
        .foreachBatch(run_batch)
        .queryName(name)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def start_console(
    df: DataFrame,
    name: str,
    num_rows: int = 20,
    truncate: bool = False,
    output_mode: str = "update",
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Print each micro-batch (debugging sink of the upstream console job).

    Without ``checkpoint`` the session's ``spark.sql.streaming.checkpointLocation``
    root is used, else a folder under the shared work folder -- never the
    driver's local temp folder.
    """
    if not checkpoint and not df.sparkSession.conf.get("spark.sql.streaming.checkpointLocation", None):
        from tickflow.session import scratch_path

        checkpoint = scratch_path(df.sparkSession, f"console-{name}")
    w = (
        df.writeStream.outputMode(output_mode)
        .format("console")
        .option("truncate", truncate)
        .option("numRows", num_rows)
        .queryName(name)
    )
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def fan_out(*writers: Writer) -> Writer:
    """One micro-batch to several writers, in order (the batch is persisted)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        for w in writers:
            w(batch, batch_id)

    return write


def run_streams(spark: SparkSession, timeout: float | None = None) -> bool:
    """Block until any active query ends (re-raising its error)."""
    return spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()


# --- writers ---------------------------------------------------------------------------


def as_stored(batch: DataFrame, stamp_now: bool = True) -> DataFrame:
    """Stream results -> stored layout: instants become UTC ``timestamp_ntz``.

    Without an ``updated_at`` column the write time is stamped (the upstream
    tables set ``now()`` on insert and update).
    """
    out = batch
    if stamp_now and "updated_at" not in out.columns:
        # One write time per batch, taken once on the driver, so every writer
        # of the batch (the table and its views) stamps the same value.
        out = out.withColumn("updated_at", F.lit(dt.datetime.now(dt.timezone.utc)))
    conv = {f.name: ntz_from_ltz(f.name) for f in out.schema.fields if isinstance(f.dataType, T.TimestampType)}
    return out.withColumns(conv) if conv else out


def store_writer(
    path: str, keys: Sequence[str], columns: Sequence[str] | None = None, views: bool = False, writer: str = "stream"
) -> Writer:
    """Upsert each batch into the table at ``path`` keyed by ``keys``; with
    ``views``, also add its candidates to the "latest" panel views in ``path/views``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        stamped = as_stored(batch)
        if columns:
            stamped = stamped.select(*columns)
        upsert(stamped, path, batch_id, keys, writer=writer, files=file_count(batch))
        if views:
            put_views(stamped, f"{path}/views", batch_id, writer=writer)

    return write


def kv_writer(path: str, to_kv: Callable[[DataFrame], DataFrame], writer: str = "put") -> Writer:
    def write(batch: DataFrame, batch_id: int) -> None:
        put_kv(to_kv(as_stored(batch, stamp_now=False)), path, batch_id, writer, files=file_count(batch))

    return write


def split_writer(good_path: str, bad_path: str, required: Sequence[str] = ("symbol", "price"), writer: str = "split") -> Writer:
    """Decoded messages (``keep_corrupt=True``) to two tables: usable ticks, and the rejected ones with their text.

    Both come from one pass over the (persisted) micro-batch.  Ticks have no key:
    read the tables by ``store.read_log``; a batch that is run again replaces its rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        for rows, path in zip(split_bad(batch, required), (good_path, bad_path)):
            day = F.to_date(ntz_from_epoch_ms("event_time"))
            upsert(rows, path, batch_id, ["event_time"], writer, part=day, files=file_count(batch))

    return write


def dbapi_writer(connect: Callable[[], object], table: str, keys: Sequence[str], **kwargs) -> Writer:
    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_dbapi(as_stored(batch, stamp_now=False), connect, table, keys, **kwargs)

    return write


def enriched_writer(
    meta: DataFrame, store_path: str | None = None, kv_path: str | None = None, writer: str = "enriched"
) -> Writer:
    """Join each batch to the dimension, then upsert rows and/or put KV cells.

    The rows of a batch are stored in order of symbol and window start.  The dimension is static: it is projected and cached here, once, which also
    fixes the rows that the broadcast bound was checked on.
    """
    side = dimension_side(meta.select(*DIMENSION_COLUMNS).persist())

    def write(batch: DataFrame, batch_id: int) -> None:
        enriched = enrich(as_stored(batch, stamp_now=False), side, broadcast_max_rows=None).persist()
        try:
            rows = enriched.count()
            if store_path:
                upsert(enriched, store_path, batch_id, TABLE_KEYS["windowed"], writer, files=file_count(enriched, rows))
            if kv_path:
                put_kv(to_kv_enriched(enriched), kv_path, batch_id, writer, files=file_count(enriched, rows))
        finally:
            enriched.unpersist()

    return write


# --- the upstream jobs ------------------------------------------------------------------


# --- fixed values: the upstream windows ---------------------------------------------
# 30 s stats with a 1 min watermark; 2 min mean every 30 s, 3 min watermark;
# 1 min anomalies, 2 min watermark.
WINDOWED_WIDTH, WINDOWED_WATERMARK = "30 seconds", "1 minute"
MOVING_WIDTH, MOVING_SLIDE, MOVING_WATERMARK = "2 minutes", "30 seconds", "3 minutes"
ANOMALY_WIDTH, ANOMALY_WATERMARK = "1 minute", "2 minutes"


def tick_aggregations(trades: DataFrame) -> dict[str, DataFrame]:
    """The three upstream aggregations with their widths and watermarks."""
    return {
        "windowed": window_stats(trades, WINDOWED_WIDTH, WINDOWED_WATERMARK),
        "moving_avg": moving_average(trades, MOVING_WIDTH, MOVING_SLIDE, MOVING_WATERMARK),
        "anomalies": range_anomalies(trades, ANOMALY_WIDTH, ANOMALY_WATERMARK),
    }


def upstream_pane() -> str:
    """The widest pane every upstream window is made of (30 s)."""
    return shared_pane(WINDOWED_WIDTH, MOVING_WIDTH, MOVING_SLIDE, ANOMALY_WIDTH)


def pane_aggregations(panes: DataFrame, pane: str) -> dict[str, DataFrame]:
    """The three upstream tables derived from one ``tick_panes`` table."""
    return {
        "windowed": window_stats_from_panes(panes, pane, WINDOWED_WIDTH),
        "moving_avg": moving_average_from_panes(panes, pane, MOVING_WIDTH, MOVING_SLIDE),
        "anomalies": range_anomalies_from_panes(panes, pane, ANOMALY_WIDTH),
    }


# Conflict keys of the stored tables (used by the external SQL upsert).
TABLE_KEYS = {
    "windowed": ["symbol", "window_start"],
    "moving_avg": ["symbol", "window_start", "window_end"],
    "anomalies": ["symbol", "window_start"],
}
_TO_KV = {"windowed": to_kv_windowed, "moving_avg": to_kv_moving_avg, "anomalies": to_kv_anomalies}
# Tables read by "latest" panels (R1, R2, R4, R6, R13) keep incremental views.
VIEW_TABLES = ("windowed", "anomalies")


def start_tick_jobs(
    trades: DataFrame,
    root: str,
    checkpoint_root: str,
    kv: bool = True,
    stores: bool = True,
    sql_connect: Callable[[], object] | None = None,
    sql_tables: dict[str, str] | None = None,
    sql_options: dict | None = None,
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """Windowed stats, moving average and anomalies, each its own query.

    Each query fans out, in order, to a KV table, a keyed parquet store and --
    when ``sql_connect`` is given -- an external SQL table (upsert on the
    table's key, ``updated_at`` stamped by the database).  ``sql_tables`` maps
    ``windowed``/``moving_avg``/``anomalies`` to table names.
    """
    queries = []
    for name, df in tick_aggregations(trades).items():
        writers = []
        if kv:
            writers.append(kv_writer(f"{root}/kv_{name}", _TO_KV[name], writer=name))
        if stores:
            writers.append(store_writer(f"{root}/{name}", TABLE_KEYS[name], views=name in VIEW_TABLES))
        if sql_connect is not None:
            table = (sql_tables or {}).get(name, name)
            writers.append(dbapi_writer(sql_connect, table, TABLE_KEYS[name], **(sql_options or {})))
        queries.append(start_query(df, f"{name}_writer", fan_out(*writers), f"{checkpoint_root}/{name}", trigger=trigger))
    return queries


def start_console_jobs(
    trades: DataFrame,
    checkpoint_root: str | None = None,
    num_rows: int = 20,
    trigger: dict | None = None,
) -> list[StreamingQuery]:
    """The three aggregations printed to the console (the upstream debug job)."""
    names = {"windowed": "windowed_aggregation", "moving_avg": "moving_average", "anomalies": "anomaly_detection"}
    return [
        start_console(
            df,
            names[name],
            num_rows=num_rows,
            checkpoint=f"{checkpoint_root}/{name}" if checkpoint_root else None,
            trigger=trigger,
        )
        for name, df in tick_aggregations(trades).items()
    ]


def start_enriched_job(
    trades: DataFrame,
    meta: DataFrame,
    root: str,
    checkpoint_root: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """30 s window stats joined to the dimension per batch, into the windowed KV."""
    stats = window_stats(trades, "30 seconds", "1 minute")
    return start_query(
        stats,
        "enriched_writer",
        enriched_writer(meta, store_path=f"{root}/enriched", kv_path=f"{root}/kv_windowed"),
        f"{checkpoint_root}/enriched",
        trigger=trigger,
    )


# --- decode once, aggregate many --------------------------------------------------------


def decoded_schema(fields: Sequence[str] | None = None) -> T.StructType:
    """Columns of the decoded-trades table written by ``start_decode_job``."""
    from tickflow.schema import TRADE
    from tickflow.sources.codec import narrow_schema

    base = narrow_schema(TRADE, fields)
    return T.StructType(
        base.fields
        + [
            T.StructField("timestamp", T.TimestampType(), True),
            T.StructField("event_date", T.DateType(), True),
        ]
    )


def start_decode_job(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    fields: Sequence[str] | None = None,
    time_from: str = "processing",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Parse the message stream once into a parquet table partitioned by day.

    Upstream, each of the four queries reads the topic and parses every JSON
    message itself.  Here one query parses, and the aggregation queries read
    the decoded table as a file stream (``read_decoded_stream``): the JSON
    cost is paid once, and each reader scans only the columns it needs.  The
    parquet file sink is exactly-once (its commit log lists the files of each
    finished batch, and readers only see committed files).
    """
    from tickflow.sources.codec import decode_trades, with_trade_time

    trades = with_trade_time(decode_trades(raw, fields=fields), time_from)
    out = trades.withColumn("event_date", F.to_date(ntz_from_ltz("timestamp")))
    w = (
        out.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("event_date")
        .queryName("decode_writer")
    )
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def read_decoded_stream(
    spark: SparkSession, path: str, fields: Sequence[str] | None = None, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of decoded trades from ``start_decode_job``'s table.

    Every trigger takes all newly committed files, i.e. whole decode batches,
    so rows reach the watermark in the order they were decoded;
    ``max_files_per_trigger`` bounds a micro-batch after an outage.
    """
    reader = spark.readStream.schema(decoded_schema(fields))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


# --- batch backfill ----------------------------------------------------------------------


def run_backfill(
    trades: DataFrame,
    root: str,
    batch_id: int,
    meta: DataFrame | None = None,
    kv: bool = True,
    stores: bool = True,
) -> None:
    """Reprocess historical ticks (a batch frame) into the same tables.

    The ticks are read, decoded and aggregated **once**, into 30 s panes per
    symbol (``tick_panes``; a partial aggregate before the only shuffle over
    tick data).  The panes are written to the shared work folder, which cuts
    the lineage: a lost executor later recomputes pane partitions from parquet,
    never from the raw ticks.  The 30 s stats are the panes themselves, the
    1 min anomalies and the 2 min / 30 s mean aggregate pane rows -- so the
    upstream's three passes over the ticks (four with the enrichment) become
    one.  The tables then go through the streaming writers as batch ``batch_id``
    of writers of their own, so it never meets a stream's batches: rerunning a
    backfill with the same id replaces its writes, and per key the newest write
    of any writer wins.
    """
    from tickflow.session import scratch_path

    if trades.isStreaming:
        raise ValueError("run_backfill takes a batch frame; use start_tick_jobs for streams")
    spark = trades.sparkSession
    pane = upstream_pane()
    panes_path = scratch_path(spark, "backfill-panes")
    tick_panes(trades, pane).write.mode("overwrite").parquet(panes_path)
    try:
        panes = spark.read.parquet(panes_path)
        work: list[tuple[DataFrame, list[Writer]]] = []
        for name, df in pane_aggregations(panes, pane).items():
            writers = []
            if kv:
                writers.append(kv_writer(f"{root}/kv_{name}", _TO_KV[name], writer=f"backfill_{name}"))
            if stores:
                views = name in VIEW_TABLES
                writers.append(store_writer(f"{root}/{name}", TABLE_KEYS[name], views=views, writer="backfill"))
            if name == "windowed" and meta is not None:
                # The enrichment joins the same 30 s stats: computed once, reused.
                writers.append(enriched_writer(meta, f"{root}/enriched", f"{root}/kv_windowed", writer="backfill_enriched"))
            work.append((df.persist(), writers))
        try:
            # The tables and writers are independent: their jobs share the cluster instead of queueing.
            with ThreadPoolExecutor(max_workers=8) as pool:
                counted = list(pool.map(lambda w: w[0].count(), work))
                done = [
                    pool.submit(_write_backfill, writer, out, batch_id, rows)
                    for (out, writers), rows in zip(work, counted)
                    for writer in writers
                ]
                for d in done:
                    d.result()
        finally:
            for out, _ in work:
                out.unpersist()
    finally:
        _delete(spark, panes_path)


def _write_backfill(writer: Writer, out: DataFrame, batch_id: int, rows: int) -> None:
    counted = _ROWS.set(rows)
    try:
        with writing_epoch("0"):
            writer(out, batch_id)
    finally:
        _ROWS.reset(counted)


# --- maintenance ---------------------------------------------------------------------------


def fold_tables(spark: SparkSession, root: str, keep_latest: int = 1) -> dict[str, int]:
    """Fold the batches of every table the jobs write under ``root`` into whole days.

    Run it from a separate batch job (say hourly): it may run beside the
    streams and readers, one at a time per table: it rewrites only the days it
    touches and leaves the newest ``keep_latest`` batches of each writer (a
    restarted stream may re-run its last one).  Tables that do not exist
    are skipped.  Returns the number of batches folded per table.
    """
    done: dict[str, int] = {}
    for name, keys in {**TABLE_KEYS, "enriched": ["symbol", "window_start"]}.items():
        path = f"{root}/{name}"
        if _exists(spark, f"{path}/log"):
            done[name] = fold(spark, path, keys, keep_latest)
        if _exists(spark, f"{path}/views"):
            fold_views(spark, f"{path}/views", keep_latest=keep_latest)
    for name in TABLE_KEYS:
        path = f"{root}/kv_{name}"
        if _exists(spark, f"{path}/log"):
            done[f"kv_{name}"] = fold_kv(spark, path, keep_latest)
    return done
