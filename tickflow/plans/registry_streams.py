"""Registered streaming queries: replayed events -> update-mode aggregation ->
foreachBatch upsert -> ``latest_by_key``.  Each returns the stored table in the
columns of its batch twin and is checked against the twin's oracle text, so
stream == batch is what the check asserts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.operators.kv import explode_cells, read_kv, to_kv_anomalies, to_kv_moving_avg, to_kv_windowed
from tickflow.operators.enrich import enrich
from tickflow.operators.store import latest_by_key, read_log
from tickflow.operators.windows import moving_average, range_anomalies, window_stats
from tickflow.plans import registry as B
from tickflow.plans.registry import _round, dimension_fixture
from tickflow.plans.registry_reports import KV_CELLS_SQL, KV_SQL
from tickflow.schema import ANOMALY_KEYS, MOVING_AVG_KEYS, WINDOWED_KEYS
from tickflow.session import scratch_path
from tickflow.sources.codec import decode_trades, encode_trades, with_trade_time
from tickflow.sources.files import read_metadata, write_metadata
from tickflow.sources.testdata import events_as_messages, events_as_trades, load_table
from tickflow.streaming.jobs import enriched_writer, fan_out, kv_writer, split_writer, start_query, store_writer
from tickflow.streaming.replay import AVAILABLE_NOW, replay_events, run_until_done, stage_messages
from tickflow.streaming.watch import TickAccount, counted_input, open_windows

N_FILES = 5
FIELDS = ["symbol", "price", "quantity", "event_time"]


def _run(spark: SparkSession, sf_dir: str, build, writer_for, name: str) -> str:
    trades, root = replay_events(spark, sf_dir, N_FILES, FIELDS)
    q = start_query(build(trades), name, writer_for(root), f"{root}/checkpoint/{name}", trigger=AVAILABLE_NOW)
    run_until_done(q)
    return root


def q_stream_window_stats_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run(
        spark, sf_dir,
        lambda t: window_stats(t, "1 hour", watermark="1 minute", stamp=True),
        lambda r: fan_out(kv_writer(f"{r}/kv_windowed", to_kv_windowed), store_writer(f"{r}/windowed", WINDOWED_KEYS)),
        "stream_window_stats_1h",
    )
    out = latest_by_key(spark, f"{root}/windowed", WINDOWED_KEYS)
    cols = ["symbol", "window_start", "window_end", "avg_price", "min_price", "max_price", "total_volume"]
    return _round(out.select(*cols), ["avg_price"])


def q_stream_moving_average_6h_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run(
        spark, sf_dir,
        lambda t: moving_average(t, "6 hours", "1 hour", watermark="3 minutes", stamp=True),
        lambda r: store_writer(f"{r}/moving_avg", MOVING_AVG_KEYS),
        "stream_moving_average_6h_1h",
    )
    out = latest_by_key(spark, f"{root}/moving_avg", MOVING_AVG_KEYS)
    cols = ["symbol", "window_start", "window_end", "moving_avg_price", "total_volume"]
    return _round(out.select(*cols), ["moving_avg_price"])


def q_stream_range_anomalies_1h_200(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run(
        spark, sf_dir,
        lambda t: range_anomalies(t, "1 hour", watermark="2 minutes", threshold=200.0, stamp=True),
        lambda r: store_writer(f"{r}/anomalies", ANOMALY_KEYS),
        "stream_range_anomalies_1h_200",
    )
    out = latest_by_key(spark, f"{root}/anomalies", ANOMALY_KEYS)
    cols = ["symbol", "window_start", "avg_price", "max_price", "min_price", "price_range_pct", "is_anomaly"]
    return _round(out.select(*cols), ["avg_price", "price_range_pct"])


def q_stream_enriched_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = dimension_fixture(spark)
    root = _run(
        spark, sf_dir,
        lambda t: window_stats(t, "1 hour", watermark="1 minute"),
        lambda r: enriched_writer(meta, store_path=f"{r}/enriched", kv_path=f"{r}/kv_enriched"),
        "stream_enriched_1h",
    )
    return latest_by_key(spark, f"{root}/enriched", WINDOWED_KEYS)


def q_stream_kv_scan_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30 s window stats streamed into a key-value table, then the dashboard scan."""
    from tickflow.plans import reports as R

    root = _run(
        spark, sf_dir,
        lambda t: window_stats(t, "30 seconds", watermark="1 minute"),
        lambda r: kv_writer(f"{r}/kv_windowed", to_kv_windowed, writer="windowed"),
        "stream_kv_scan_windowed",
    )
    return R.scan_windowed(read_kv(spark, f"{root}/kv_windowed", "error", 20), "error")


def q_stream_window_stats_1h_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed hourly stats, its batches folded into days, then read back."""
    from tickflow.operators.store import fold

    root = _run(
        spark, sf_dir,
        lambda t: window_stats(t, "1 hour", watermark="1 minute"),
        lambda r: store_writer(f"{r}/windowed", WINDOWED_KEYS),
        "stream_window_stats_1h_compacted",
    )
    fold(spark, f"{root}/windowed", WINDOWED_KEYS, keep_latest=1)
    out = latest_by_key(spark, f"{root}/windowed", WINDOWED_KEYS)
    cols = ["symbol", "window_start", "window_end", "avg_price", "min_price", "max_price", "total_volume"]
    return _round(out.select(*cols), ["avg_price"])


def q_stream_kv_scan_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed 30 s key-value puts, folded by ``fold_kv``, then scanned."""
    from tickflow.operators.kv import fold_kv
    from tickflow.plans import reports as R

    root = _run(
        spark, sf_dir,
        lambda t: window_stats(t, "30 seconds", watermark="1 minute"),
        lambda r: kv_writer(f"{r}/kv_windowed", to_kv_windowed, writer="windowed"),
        "stream_kv_scan_compacted",
    )
    fold_kv(spark, f"{root}/kv_windowed", keep_latest=1)
    return R.scan_windowed(read_kv(spark, f"{root}/kv_windowed", "error", 20), "error")


def q_backfill_window_stats_30s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch backfill of all upstream tables from events, windowed table read back."""
    from tickflow.plans.registry import trades as batch_trades
    from tickflow.streaming.jobs import run_backfill

    root = scratch_path(spark, "backfill")
    run_backfill(batch_trades(spark, sf_dir), root, 0, meta=dimension_fixture(spark))
    out = latest_by_key(spark, f"{root}/windowed", WINDOWED_KEYS)
    cols = ["symbol", "window_start", "window_end", "avg_price", "min_price", "max_price", "total_volume"]
    return _round(out.select(*cols), ["avg_price"])


# --- several writers of one table ---------------------------------------------------------
# The ticks before SPLIT_MS and those from then on reach one windowed table by
# different writers, so its rows must be those of all ticks: nothing that one
# writer stored may hide or replace what another stored.
SPLIT_MS = 1_706_315_400_000  # 2024-01-27 00:30:00 UTC, the start of a window
WINDOW_COLUMNS = ["symbol", "window_start", "window_end", "avg_price", "min_price", "max_price", "total_volume"]


def _stream_part(spark: SparkSession, sf_dir: str, root: str, checkpoint: str, late: bool) -> None:
    trades, _ = replay_events(spark, sf_dir, 2, FIELDS, root=f"{root}/replay-{checkpoint}")
    ticks = trades.where((F.col("event_time") >= SPLIT_MS) if late else (F.col("event_time") < SPLIT_MS))
    q = start_query(window_stats(ticks, "30 seconds", watermark="1 minute"), f"part_{checkpoint}",
                    store_writer(f"{root}/windowed", WINDOWED_KEYS, views=True),
                    f"{root}/checkpoint/{checkpoint}", trigger=AVAILABLE_NOW)
    run_until_done(q)


def _backfill_part(spark: SparkSession, sf_dir: str, root: str, late: bool) -> None:
    from tickflow.plans.registry import trades as batch_trades
    from tickflow.streaming.jobs import run_backfill

    ticks = batch_trades(spark, sf_dir)
    run_backfill(ticks.where((F.col("event_time") >= SPLIT_MS) if late else (F.col("event_time") < SPLIT_MS)),
                 root, batch_id=0, kv=False)


def _windowed(spark: SparkSession, root: str) -> DataFrame:
    return _round(latest_by_key(spark, f"{root}/windowed", WINDOWED_KEYS).select(*WINDOW_COLUMNS), ["avg_price"])


def q_stored_stream_then_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream, then a backfill with batch id 0 into the same root."""
    root = scratch_path(spark, "stream-backfill")
    _stream_part(spark, sf_dir, root, "a", late=False)
    _backfill_part(spark, sf_dir, root, late=True)
    return _windowed(spark, root)


def q_stored_backfill_after_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream whose log is folded whole, then a backfill with batch id 0, folded too."""
    from tickflow.streaming.jobs import fold_tables

    root = scratch_path(spark, "compact-backfill")
    _stream_part(spark, sf_dir, root, "a", late=True)
    fold_tables(spark, root, keep_latest=0)
    _backfill_part(spark, sf_dir, root, late=False)
    fold_tables(spark, root, keep_latest=0)
    return _windowed(spark, root)


def q_stored_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream, folded, and its successor with a new checkpoint, whose batches count from 0 again."""
    from tickflow.streaming.jobs import fold_tables

    root = scratch_path(spark, "new-checkpoint")
    _stream_part(spark, sf_dir, root, "a", late=False)
    fold_tables(spark, root, keep_latest=0)
    _stream_part(spark, sf_dir, root, "b", late=True)
    return _windowed(spark, root)


# --- all cells of the streamed key-value tables ---------------------------------------------


def q_stream_kv_cells_two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windowed, then enriched puts streamed into one key-value table; every cell read back."""
    trades, root = replay_events(spark, sf_dir, N_FILES, FIELDS)
    for name, writer in (
        ("windowed", kv_writer(f"{root}/kv_windowed", to_kv_windowed, writer="windowed")),
        ("enriched", enriched_writer(dimension_fixture(spark), kv_path=f"{root}/kv_windowed")),
    ):
        stats = window_stats(trades, "30 seconds", watermark="1 minute")
        run_until_done(start_query(stats, f"kv_{name}", writer, f"{root}/checkpoint/{name}", trigger=AVAILABLE_NOW))
    return explode_cells(read_kv(spark, f"{root}/kv_windowed"))


def q_stream_kv_cells_moving_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run(
        spark, sf_dir,
        lambda t: moving_average(t, "2 minutes", "30 seconds", watermark="3 minutes"),
        lambda r: kv_writer(f"{r}/kv_moving_avg", to_kv_moving_avg, writer="moving_avg"),
        "stream_kv_cells_moving_avg",
    )
    return explode_cells(read_kv(spark, f"{root}/kv_moving_avg"))


def q_stream_kv_cells_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run(
        spark, sf_dir,
        lambda t: range_anomalies(t, "1 minute", watermark="2 minutes"),
        lambda r: kv_writer(f"{r}/kv_anomalies", to_kv_anomalies, writer="anomalies"),
        "stream_kv_cells_anomalies",
    )
    return explode_cells(read_kv(spark, f"{root}/kv_anomalies"))


# --- late ticks, open windows, rejected messages, the dimension as a file ---------------------
LATE_BEFORE_MS = 1_705_276_800_000  # 2024-01-15 00:00:00 UTC
LATE_ONE_IN = 50
OPEN_WATERMARK = "2 days"


def _late_run(spark: SparkSession, sf_dir: str):
    """Hourly stats of a replay in which some ticks of the first half come after all others."""
    root = scratch_path(spark, "late")
    late = (F.col("ts") < LATE_BEFORE_MS) & (F.col("ts") % LATE_ONE_IN == 0)
    messages = events_as_messages(load_table(spark, sf_dir, "events"), keep_ts=True)
    messages = messages.withColumn("turn", F.struct(late.alias("late"), "ts"))
    staged = stage_messages(spark, messages, f"{root}/in", N_FILES, "turn")
    ticks = with_trade_time(decode_trades(staged, fields=FIELDS), "event_time")
    name = root.rsplit("/", 1)[1]
    account = TickAccount(name)
    spark.streams.addListener(account)
    try:
        stats = window_stats(counted_input(ticks), "1 hour", watermark="1 minute", count=True)
        q = start_query(stats, name, store_writer(f"{root}/windowed", WINDOWED_KEYS), f"{root}/checkpoint", trigger=AVAILABLE_NOW)
        run_until_done(q)
        account.wait()
    finally:
        spark.streams.removeListener(account)
    return latest_by_key(spark, f"{root}/windowed", WINDOWED_KEYS), account


def q_stream_late_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows of the ticks that came in time."""
    kept, _ = _late_run(spark, sf_dir)
    return _round(kept.select(*WINDOW_COLUMNS, "n_ticks"), ["avg_price"])


def q_stream_late_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks read, kept and dropped as late, and the groups that Spark reports as dropped."""
    kept, account = _late_run(spark, sf_dir)
    read = F.lit(account.total("ticks")).cast("long")
    return kept.agg(F.sum("n_ticks").alias("kept_ticks")).select(
        read.alias("read_ticks"), "kept_ticks", (read - F.col("kept_ticks")).alias("dropped_ticks"),
        F.lit(account.total("late_groups")).cast("long").alias("dropped_groups"),
    )


_LATE_SQL = f"epoch_us(ts) // 1000 < {LATE_BEFORE_MS} AND (epoch_us(ts) // 1000) % {LATE_ONE_IN} = 0"
SQL_LATE_TICKS = f"""WITH {B.TRADES_CTE}
SELECT symbol, {B._bucket('1 hour')} AS window_start, {B._bucket('1 hour')} + INTERVAL '1 hour' AS window_end,
       round(avg(price), {B.MEAN_DIGITS}) AS avg_price, min(price) AS min_price, max(price) AS max_price,
       sum(quantity) AS total_volume, count(*) AS n_ticks
FROM trades WHERE NOT ({_LATE_SQL}) GROUP BY 1, 2, 3"""
SQL_LATE_ACCOUNT = f"""WITH {B.TRADES_CTE}
SELECT count(*) AS read_ticks, count(*) FILTER (WHERE NOT ({_LATE_SQL})) AS kept_ticks,
       count(*) FILTER (WHERE {_LATE_SQL}) AS dropped_ticks,
       count(DISTINCT symbol || CAST({B._bucket('1 hour')} AS VARCHAR)) FILTER (WHERE {_LATE_SQL}) AS dropped_groups
FROM trades"""


def q_stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly windows that the state store still holds after a replay."""
    trades, root = replay_events(spark, sf_dir, N_FILES, FIELDS)
    stats = window_stats(trades, "1 hour", watermark=OPEN_WATERMARK)
    q = start_query(stats, "stream_open_windows", store_writer(f"{root}/windowed", WINDOWED_KEYS),
                    f"{root}/checkpoint/open", trigger=AVAILABLE_NOW)
    run_until_done(q)
    return _round(open_windows(spark, f"{root}/checkpoint/open"), ["avg_price"])


SQL_OPEN_WINDOWS = f"""SELECT * FROM ({B.sql_window_stats('1 hour')})
WHERE window_end > (SELECT make_timestamp((epoch_us(max(ts)) // 1000) * 1000) FROM events) - INTERVAL '{OPEN_WATERMARK}'"""

# Planted faults, by the tick's time in milliseconds: no price, no symbol, cut text.
NO_PRICE, NO_SYMBOL, CUT_TEXT = 7, 11, 13


def q_stream_rejected_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with planted faults, split into usable and rejected ticks; hourly digests of both tables."""
    root = scratch_path(spark, "rejected")
    ms = F.col("event_time")
    ticks = events_as_trades(load_table(spark, sf_dir, "events"))
    ticks = ticks.withColumns({"price": F.when(ms % NO_PRICE != 0, F.col("price")), "symbol": F.when(ms % NO_SYMBOL != 0, F.col("symbol")), "ts": ms})
    messages = encode_trades(ticks, keep=["ts"])
    cut = F.when(F.col("ts") % CUT_TEXT == 0, F.substring("value", 1, 20)).otherwise(F.col("value"))
    staged = stage_messages(spark, messages.withColumn("value", cut), f"{root}/in", N_FILES, "ts")
    decoded = decode_trades(staged, fields=FIELDS, keep_corrupt=True)
    q = start_query(decoded, "stream_rejected_ticks", split_writer(f"{root}/good", f"{root}/bad"),
                    f"{root}/checkpoint/split", output_mode="append", trigger=AVAILABLE_NOW)
    run_until_done(q)
    digests = []
    for output, path in (("kept", "good"), ("rejected", "bad")):
        rows = with_trade_time(read_log(spark, f"{root}/{path}"), "event_time", as_ntz=True)
        hourly = rows.groupBy("symbol", F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("window_start"))
        priced = F.count("price").alias("n_priced")
        digests.append(hourly.agg(F.count(F.lit(1)).alias("n"), priced, F.avg("price").alias("avg_price")).withColumn("output", F.lit(output)))
    return _round(digests[0].unionByName(digests[1]), ["avg_price"])


SQL_REJECTED_TICKS = f"""WITH ticks AS (SELECT epoch_us(ts) // 1000 AS ms, event_type, value FROM events),
sent AS (
  SELECT ms % {CUT_TEXT} = 0 AS cut,
         CASE WHEN ms % {CUT_TEXT} <> 0 AND ms % {NO_SYMBOL} <> 0 THEN event_type END AS symbol,
         CASE WHEN ms % {CUT_TEXT} <> 0 AND ms % {NO_PRICE} <> 0 THEN value END AS price,
         CASE WHEN ms % {CUT_TEXT} <> 0 THEN make_timestamp(ms * 1000) END AS ts
  FROM ticks)
SELECT CASE WHEN cut OR symbol IS NULL OR price IS NULL THEN 'rejected' ELSE 'kept' END AS output,
       symbol, {B._bucket('1 hour')} AS window_start, count(*) AS n, count(price) AS n_priced,
       round(avg(price), {B.MEAN_DIGITS}) AS avg_price
FROM sent GROUP BY 1, 2, 3"""


def q_enriched_csv_dimension_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly stats joined to a dimension that was written as CSV and read back."""
    path = scratch_path(spark, "dimension")
    write_metadata(dimension_fixture(spark), path)
    return enrich(window_stats(B.trades(spark, sf_dir), "1 hour"), read_metadata(spark, path))


def stream_registry() -> dict:
    return {
        "stream_window_stats_1h": (q_stream_window_stats_1h, B.sql_window_stats("1 hour")),
        "stream_moving_average_6h_1h": (
            q_stream_moving_average_6h_1h,
            B.sql_moving_average("6 hours", "1 hour", 6),
        ),
        "stream_range_anomalies_1h_200": (
            q_stream_range_anomalies_1h_200,
            B.sql_range_anomalies("1 hour", 200.0),
        ),
        "stream_enriched_1h": (q_stream_enriched_1h, B.sql_enriched_stats("1 hour")),
        # Symbol "error" is outside the dimension, so the batch twin's merged
        # table holds only the windowed puts for it: the same oracle text.
        "stream_kv_scan_windowed": (q_stream_kv_scan_windowed, KV_SQL["kv_scan_windowed"]),
        "stream_decoded_window_stats_1h": (q_stream_decoded_window_stats_1h, B.sql_window_stats("1 hour")),
        "stream_window_stats_1h_compacted": (q_stream_window_stats_1h_compacted, B.sql_window_stats("1 hour")),
        "stream_kv_scan_compacted": (q_stream_kv_scan_compacted, KV_SQL["kv_scan_windowed"]),
        "stored_stream_then_backfill": (q_stored_stream_then_backfill, B.sql_window_stats("30 seconds")),
        "stored_backfill_after_compact": (q_stored_backfill_after_compact, B.sql_window_stats("30 seconds")),
        "stored_new_checkpoint": (q_stored_new_checkpoint, B.sql_window_stats("30 seconds")),
        "stream_kv_cells_two_writers": (q_stream_kv_cells_two_writers, KV_SQL["kv_merge_cells"]),
        "stream_kv_cells_moving_avg": (q_stream_kv_cells_moving_avg, KV_CELLS_SQL["moving_avg"]),
        "stream_kv_cells_anomalies": (q_stream_kv_cells_anomalies, KV_CELLS_SQL["anomalies"]),
        "stream_late_ticks": (q_stream_late_ticks, SQL_LATE_TICKS),
        "stream_late_account": (q_stream_late_account, SQL_LATE_ACCOUNT),
        "stream_open_windows": (q_stream_open_windows, SQL_OPEN_WINDOWS),
        "stream_rejected_ticks": (q_stream_rejected_ticks, SQL_REJECTED_TICKS),
        "enriched_csv_dimension_1h": (q_enriched_csv_dimension_1h, B.sql_enriched_stats("1 hour")),
        "backfill_window_stats_30s": (q_backfill_window_stats_30s, B.sql_window_stats("30 seconds")),
    }




def q_stream_decoded_window_stats_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two hops: replayed messages -> decoded parquet table -> hourly stats."""
    from tickflow.streaming.jobs import read_decoded_stream, start_decode_job
    from tickflow.streaming.replay import stage_events

    raw, root = stage_events(spark, sf_dir, N_FILES)
    dec = start_decode_job(raw, f"{root}/decoded", f"{root}/checkpoint/decode", fields=FIELDS,
                           time_from="event_time", trigger=AVAILABLE_NOW)
    run_until_done(dec)
    trades = read_decoded_stream(spark, f"{root}/decoded", FIELDS)
    q = start_query(window_stats(trades, "1 hour", watermark="1 minute"), "decoded_window_stats",
                    store_writer(f"{root}/windowed", WINDOWED_KEYS), f"{root}/checkpoint/windowed", trigger=AVAILABLE_NOW)
    run_until_done(q)
    out = latest_by_key(spark, f"{root}/windowed", WINDOWED_KEYS)
    cols = ["symbol", "window_start", "window_end", "avg_price", "min_price", "max_price", "total_volume"]
    return _round(out.select(*cols), ["avg_price"])
