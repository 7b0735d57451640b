import datetime as dt

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from tickflow.operators.store import latest_by_key
from tickflow.operators.windows import window_stats
from tickflow.plans import registry_streams
from tickflow.session import scratch_path
from tickflow.sources.codec import decode_trades, encode_trades, with_trade_time
from tickflow.sources.files import read_file_trades, stage_replay
from tickflow.sources.kafka import kafka_sink_options, kafka_source_options, read_kafka_trades
from tickflow.streaming import replay
from tickflow.streaming.jobs import checkpoint_id, fan_out, start_console, start_query, store_writer
from tickflow.streaming.replay import AVAILABLE_NOW, replay_events, run_until_done

from paths import SF_SMALL

KEYS = ["symbol", "window_start"]


def _stage(spark, rows, n_files):
    """rows: (seq, symbol, price, epoch_ms) -> staged files in seq order."""
    df = spark.createDataFrame(rows, "seq long, symbol string, price double, event_time long").withColumn(
        "quantity", F.lit(1.0)
    )
    path = scratch_path(spark, "stage")
    stage_replay(encode_trades(df, keep=["seq"]), f"{path}/in", n_files, "seq")
    stream = with_trade_time(decode_trades(read_file_trades(spark, f"{path}/in")), "event_time")
    return stream, path


def test_late_row_is_dropped(spark):
    # Spark filters late rows against the watermark of the batch before, so
    # the row from day 1 arrives two batches after the watermark reached day 31.
    day31 = int(dt.datetime(2024, 1, 31, 12, tzinfo=dt.timezone.utc).timestamp() * 1000)
    day1 = int(dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc).timestamp() * 1000)
    rows = [(0, "A", 1.0, day31), (1, "A", 2.0, day31 + 1000), (2, "A", 5.0, day1)]
    stream, path = _stage(spark, rows, 3)
    seen = []

    def collect(batch, batch_id):
        seen.append((batch_id, sorted((r.window_start, r.avg_price) for r in batch.collect())))

    q = start_query(window_stats(stream, "30 seconds", "1 minute"), "late_test", collect,
                    f"{path}/ckpt", trigger=AVAILABLE_NOW, skip_empty=False)
    run_until_done(q)
    assert [len(rows) for _, rows in seen[:3]] == [1, 1, 0], seen
    assert seen[1][1][0][1] == 1.5  # update mode re-emits the grown window
    assert all(not rows for _, rows in seen[2:])


def _events_bytes(spark):
    import os

    return os.path.getsize(f"{SF_SMALL}/events.parquet")


@pytest.mark.parametrize("files_per_batch", [1, 3])
def test_replay_in_batches_equals_batch(spark, files_per_batch):
    # file_bytes small enough that each micro-batch is several range files
    file_bytes = -(-_events_bytes(spark) // (5 * files_per_batch))
    trades, root = replay_events(
        spark, SF_SMALL, 5, ["symbol", "price", "quantity", "event_time"], file_bytes=file_bytes
    )
    batches = []

    def count(batch, batch_id):
        batches.append(batch_id)

    q = start_query(window_stats(trades, "1 hour", "1 minute"), "replay_test",
                    fan_out(store_writer(f"{root}/w", KEYS), count), f"{root}/ckpt", trigger=AVAILABLE_NOW)
    run_until_done(q)
    assert len(batches) == 5
    streamed = latest_by_key(spark, f"{root}/w", ["symbol", "window_start"])
    assert "updated_at" in streamed.columns  # write time stamped
    from tickflow.plans.registry import trades as batch_trades

    batch = window_stats(batch_trades(spark, SF_SMALL), "1 hour")
    cols = ["symbol", "window_start", "avg_price", "min_price", "max_price", "total_volume"]

    def norm(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())

    assert norm(streamed) == norm(batch)


def test_replay_files_hold_a_bounded_number_of_messages(spark, monkeypatch):
    # A staging task sorts a whole file, so files are bounded in messages too: those of small compressed rows take far more in the sort.
    monkeypatch.setattr(replay, "REPLAY_FILE_ROWS", 50, raising=False)
    total = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    trades, root = replay_events(spark, SF_SMALL, 2, ["symbol", "price", "quantity", "event_time"])
    held = spark.read.parquet(f"{root}/in").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in held) == total > 8 * 50
    assert max(r["count"] for r in held) <= 2 * 50  # ranges are cut from a sample
    batches = []
    q = start_query(trades, "bounded_files", lambda batch, _: batches.append(batch.select("event_time").collect()),
                    f"{root}/ckpt", output_mode="append", trigger=AVAILABLE_NOW)
    run_until_done(q)
    assert len(batches) == 2 and sum(map(len, batches)) == total  # still two batches, in time order
    assert max(batches[0]) <= min(batches[1])


@pytest.mark.parametrize("name", ["stream_late_ticks", "stream_late_account", "stream_rejected_ticks"])
def test_all_replays_bound_their_files(spark, monkeypatch, name):
    query, _ = registry_streams.stream_registry()[name]
    rows = sorted(map(str, query(spark, SF_SMALL).collect()))
    staged, real = [], replay.stage_replay
    monkeypatch.setattr(replay, "REPLAY_FILE_ROWS", 50, raising=False)
    monkeypatch.setattr(replay, "stage_replay", lambda *args: staged.append(real(*args)))
    assert sorted(map(str, query(spark, SF_SMALL).collect())) == rows
    assert len(staged) == 1 and len(staged[0]) > registry_streams.N_FILES


def test_writer_error_fails_the_query(spark):
    stream, path = _stage(spark, [(0, "A", 1.0, 1_700_000_000_000)], 1)

    def boom(batch, batch_id):
        raise ValueError("sink down")

    q = start_query(window_stats(stream, "30 seconds"), "fail_test", boom, f"{path}/ckpt", trigger=AVAILABLE_NOW)
    with pytest.raises(StreamingQueryException, match="sink down"):
        run_until_done(q)


def test_console_sink_runs(spark, capsys):
    stream, path = _stage(spark, [(0, "A", 1.0, 1_700_000_000_000)], 1)
    q = start_console(window_stats(stream, "30 seconds"), "console_test", checkpoint=f"{path}/ckpt",
                      trigger=AVAILABLE_NOW)
    run_until_done(q)


def test_kafka_options():
    o = kafka_source_options("h:9092", "t")
    assert o == {"kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "latest",
                 "failOnDataLoss": "false"}
    s = kafka_sink_options("h:9092", "t")
    assert s["kafka.acks"] == "all" and s["kafka.retries"] == "5" and s["topic"] == "t"


def test_kafka_reader_needs_connector(spark):
    # The connector jar is not on this machine: building works, loading fails cleanly.
    with pytest.raises(AnalysisException, match="kafka"):
        read_kafka_trades(spark, "localhost:9092", "trades")


def test_all_jobs_end_to_end(spark):
    """Three tick queries and the enriched query on one replayed stream; the
    windowed and enriched queries share one key-value table."""
    from tickflow.operators.kv import read_kv
    from tickflow.plans.registry import dimension_fixture
    from tickflow.streaming.jobs import start_enriched_job, start_tick_jobs

    trades, root = replay_events(spark, SF_SMALL, 3, ["symbol", "price", "quantity", "event_time"])
    qs = start_tick_jobs(trades, f"{root}/out", f"{root}/ckpt", trigger=AVAILABLE_NOW)
    qs.append(start_enriched_job(trades, dimension_fixture(spark), f"{root}/out", f"{root}/ckpt",
                                 trigger=AVAILABLE_NOW))
    run_until_done(*qs)
    assert sorted(q.name for q in qs) == ["anomalies_writer", "enriched_writer", "moving_avg_writer",
                                          "windowed_writer"]
    kv = read_kv(spark, f"{root}/out/kv_windowed")
    cells = {r.row_key.split("_")[0]: set(r.cells) for r in kv.collect()}
    assert cells["error"] == {"price:avg", "price:min", "price:max", "volume:total"}  # not in the dimension
    assert {"price:status", "price:full_name", "volume:total", "price:avg"} <= cells["click"]
    stored = latest_by_key(spark, f"{root}/out/windowed", ["symbol", "window_start"])
    from tickflow.plans.registry import trades as batch_trades

    batch = window_stats(batch_trades(spark, SF_SMALL), "30 seconds")
    assert stored.count() == batch.count()
    assert latest_by_key(spark, f"{root}/out/anomalies", ["symbol", "window_start"]).count() > 0
    from tickflow.plans import reports as R

    latest = R.latest_avg_price(stored).collect()  # reports run on the stream-written table
    assert [r.symbol for r in latest] == ["click", "error", "purchase", "signup", "view"]
    assert R.freshness_seconds(stored, "2100-01-01 00:00:00").first().band == "red"
    assert read_kv(spark, f"{root}/out/kv_moving_avg").count() > 0


def test_processing_time_puts_a_batch_in_one_window(spark):
    from tickflow.plans.registry import trades as batch_trades

    t = with_trade_time(batch_trades(spark, SF_SMALL).drop("timestamp"), "processing", as_ntz=True)
    out = window_stats(t, "30 seconds")
    assert out.select("window_start").distinct().count() == 1


def test_run_streams_returns_when_one_ends(spark):
    from tickflow.streaming.jobs import run_streams

    spark.streams.resetTerminated()  # an earlier test left a failed query behind
    stream, path = _stage(spark, [(0, "A", 1.0, 1_700_000_000_000)], 1)
    q = start_query(window_stats(stream, "30 seconds"), "any_end", lambda b, i: None, f"{path}/ckpt",
                    trigger=AVAILABLE_NOW)
    assert run_streams(spark, timeout=120) is True
    q.awaitTermination()
    spark.streams.resetTerminated()


def test_console_default_checkpoint_is_shared_folder(spark):
    from tickflow.operators.store import _glob
    from tickflow.session import work_dir

    stream, path = _stage(spark, [(0, "A", 1.0, 1_700_000_000_000)], 1)
    q = start_console(window_stats(stream, "30 seconds"), "console_default", trigger=AVAILABLE_NOW)
    run_until_done(q)
    (found,) = _glob(spark, f"{work_dir(spark)}/console-console_default-*/metadata")
    assert checkpoint_id(spark, found.rsplit("/", 1)[0]) == str(q.id)


def test_text_replay_source(spark):
    """One JSON message per line, read as the Kafka-style binary ``value``."""
    path = scratch_path(spark, "text")
    lines = spark.createDataFrame(
        [('{"symbol":"A","price":1.0,"quantity":2.0,"event_time":1700000000000}',),
         ('{"symbol":"A","price":3.0,"quantity":1.0,"event_time":1700000001000}',)], "value string")
    lines.coalesce(1).write.text(f"{path}/in")
    stream = with_trade_time(decode_trades(read_file_trades(spark, f"{path}/in", fmt="text")), "event_time")
    out = []
    q = start_query(window_stats(stream, "30 seconds"), "text_src",
                    lambda b, i: out.extend(b.collect()), f"{path}/ckpt", trigger=AVAILABLE_NOW)
    run_until_done(q)
    assert [(r.symbol, r.avg_price, r.total_volume) for r in out] == [("A", 2.0, 3.0)]


def test_tick_jobs_with_sql_sink_and_console(spark, tmp_path):
    import sqlite3

    from tickflow.streaming.jobs import start_console_jobs, start_tick_jobs

    db = str(tmp_path / "tick.db")
    con = sqlite3.connect(db)
    con.executescript(
        "CREATE TABLE w (symbol TEXT, window_start TEXT, window_end TEXT, avg_price REAL, min_price REAL, "
        "max_price REAL, total_volume REAL, updated_at TEXT DEFAULT CURRENT_TIMESTAMP, PRIMARY KEY (symbol, window_start));"
        "CREATE TABLE m (symbol TEXT, window_start TEXT, window_end TEXT, moving_avg_price REAL, total_volume REAL, "
        "updated_at TEXT DEFAULT CURRENT_TIMESTAMP, PRIMARY KEY (symbol, window_start, window_end));"
        "CREATE TABLE a (symbol TEXT, window_start TEXT, avg_price REAL, max_price REAL, min_price REAL, "
        "price_range_pct REAL, is_anomaly INTEGER, updated_at TEXT DEFAULT CURRENT_TIMESTAMP, PRIMARY KEY (symbol, window_start));"
    )
    con.close()

    def connect(path=db):
        import sqlite3 as s

        return s.connect(path, timeout=60)

    def to_sql(v):
        import datetime as d

        return v.isoformat(sep=" ") if isinstance(v, d.datetime) else v

    trades, root = replay_events(spark, SF_SMALL, 2, ["symbol", "price", "quantity", "event_time"])
    qs = start_tick_jobs(trades, f"{root}/out", f"{root}/ckpt", kv=False, sql_connect=connect,
                         sql_tables={"windowed": "w", "moving_avg": "m", "anomalies": "a"},
                         sql_options={"convert": to_sql}, trigger=AVAILABLE_NOW)
    run_until_done(*qs)
    stored = latest_by_key(spark, f"{root}/out/windowed", ["symbol", "window_start"]).count()
    c = sqlite3.connect(db)
    assert c.execute("SELECT count(*) FROM w").fetchone()[0] == stored
    assert c.execute("SELECT count(*) FROM m").fetchone()[0] > 0
    assert c.execute("SELECT count(*) FROM a WHERE updated_at IS NOT NULL").fetchone()[0] > 0
    cq = start_console_jobs(trades, f"{root}/console", trigger=AVAILABLE_NOW)
    run_until_done(*cq)
    assert sorted(q.name for q in cq) == ["anomaly_detection", "moving_average", "windowed_aggregation"]


def test_enrich_directly_on_the_stream(spark):
    """Stream-static inner join in update mode (no foreachBatch needed)."""
    from tickflow.operators.enrich import enrich
    from tickflow.plans.registry import dimension_fixture

    trades, root = replay_events(spark, SF_SMALL, 2, ["symbol", "price", "quantity", "event_time"])
    enriched = enrich(window_stats(trades, "1 hour", watermark="1 minute"), dimension_fixture(spark))
    q = start_query(enriched, "enrich_stream", store_writer(f"{root}/e", KEYS), f"{root}/ckpt", trigger=AVAILABLE_NOW)
    run_until_done(q)
    out = latest_by_key(spark, f"{root}/e", ["symbol", "window_start"])
    symbols = {r.symbol for r in out.select("symbol").distinct().collect()}
    assert symbols == {"click", "purchase", "signup", "view"}  # error dropped, refund unmatched
    assert set(out.columns) >= {"full_name", "status", "price_range_pct"}


def test_kafka_scale_options():
    o = kafka_source_options("h:9092", "t", max_offsets_per_trigger=1_000_000, min_partitions=64)
    assert o["maxOffsetsPerTrigger"] == "1000000" and o["minPartitions"] == "64"


def test_restart_after_crash_between_write_and_commit(spark):
    """The sink write of batch 2 lands, then the query dies before Spark commits
    the batch.  Restarted from its checkpoint, Spark re-runs batch 2; the upsert
    overwrites its own partition and the table equals the batch answer."""
    trades, root = replay_events(spark, SF_SMALL, 4, ["symbol", "price", "quantity", "event_time"])
    agg = window_stats(trades, "1 hour", watermark="1 minute")
    write = store_writer(f"{root}/w", KEYS)
    calls = []

    def crashing(batch, batch_id):
        write(batch, batch_id)
        calls.append(batch_id)
        if batch_id == 2 and calls.count(2) == 1:
            raise RuntimeError("executor lost after the write")

    q = start_query(agg, "crash_once", crashing, f"{root}/ckpt", trigger=AVAILABLE_NOW)
    with pytest.raises(StreamingQueryException, match="executor lost after the write"):
        run_until_done(q)
    spark.streams.resetTerminated()
    q2 = start_query(agg, "crash_once", crashing, f"{root}/ckpt", trigger=AVAILABLE_NOW)
    run_until_done(q2)
    assert calls.count(2) == 2 and calls.count(0) == 1  # only the uncommitted batch re-ran
    from tickflow.plans.registry import trades as batch_trades

    batch = window_stats(batch_trades(spark, SF_SMALL), "1 hour")
    cols = ["symbol", "window_start", "avg_price", "min_price", "max_price", "total_volume"]

    def norm(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())

    assert norm(latest_by_key(spark, f"{root}/w", ["symbol", "window_start"])) == norm(batch)


def test_backfill_writes_every_table_and_is_idempotent(spark):
    from tickflow.operators.kv import read_kv
    from tickflow.plans.registry import dimension_fixture
    from tickflow.plans.registry import trades as batch_trades
    from tickflow.streaming.jobs import run_backfill

    root = scratch_path(spark, "backfill")
    t = batch_trades(spark, SF_SMALL)
    run_backfill(t, root, 0, meta=dimension_fixture(spark))
    counts = {n: latest_by_key(spark, f"{root}/{n}", ["symbol", "window_start"]).count()
              for n in ("windowed", "anomalies", "enriched")}
    run_backfill(t, root, 0, meta=dimension_fixture(spark))  # rerun: same partitions replaced
    again = {n: latest_by_key(spark, f"{root}/{n}", ["symbol", "window_start"]).count()
             for n in ("windowed", "anomalies", "enriched")}
    assert counts == again and counts["windowed"] == window_stats(t, "30 seconds").count()
    cells = {r.row_key.split("_")[0]: set(r.cells) for r in read_kv(spark, f"{root}/kv_windowed").collect()}
    assert "price:status" in cells["click"] and "price:status" not in cells["error"]


def test_a_batch_is_counted_once_for_all_writers(spark, monkeypatch):
    from tickflow.operators.kv import to_kv_windowed
    from tickflow.streaming import jobs

    counted = []
    count = type(spark.range(1)).count
    monkeypatch.setattr(type(spark.range(1)), "count", lambda df: (counted.append(1), count(df))[1])
    trades, root = replay_events(spark, SF_SMALL, 2, ["symbol", "price", "quantity", "event_time"])
    writers = fan_out(jobs.kv_writer(f"{root}/kv", to_kv_windowed), store_writer(f"{root}/w", KEYS, views=True))
    batches = []
    q = start_query(window_stats(trades, "1 hour", "1 minute"), "count_once", fan_out(writers, lambda b, i: batches.append(i)),
                    f"{root}/ckpt", trigger=AVAILABLE_NOW)
    run_until_done(q)
    assert len(counted) <= len(batches) + 1  # at most one batch more, an empty one


def test_small_batch_writes_one_file_a_day_sorted_by_key(spark):
    from tickflow.operators.store import read_log, upsert
    from tickflow.streaming.jobs import file_count

    day = dt.datetime(2024, 1, 1)
    rows = [(f"s{i % 7}", day + dt.timedelta(hours=i % 48)) for i in range(500)]
    df = spark.createDataFrame(rows, "symbol string, window_start timestamp_ntz").repartition(8)
    path = scratch_path(spark, "files")
    upsert(df, path, 0, KEYS, files=file_count(df, 500))
    files = read_log(spark, path).inputFiles()
    assert len(files) == 2 and len({f.split("/day_=")[1][:11] for f in files}) == 2
    for f in files:
        own = [(r.symbol, r.window_start) for r in spark.read.parquet(f).collect()]
        assert own == sorted(own)
    assert file_count(df, 10**6) == 4


def _ticks(spark, rows):
    """(symbol, price, epoch second) -> batch trades."""
    df = spark.createDataFrame([(s, p, 1.0, 1000 * t) for s, p, t in rows], "symbol string, price double, quantity double, event_time long")
    return with_trade_time(df, "event_time", as_ntz=True)


def _stream(spark, rows, root, checkpoint):
    stream, _ = _stage(spark, [(i, s, p, 1000 * t) for i, (s, p, t) in enumerate(rows)], 1)
    run_until_done(start_query(window_stats(stream, "30 seconds"), f"s_{checkpoint}", store_writer(f"{root}/windowed", KEYS, views=True),
                               f"{root}/ckpt-{checkpoint}", trigger=AVAILABLE_NOW))


def _prices(spark, root):
    return sorted((r.symbol, r.avg_price) for r in latest_by_key(spark, f"{root}/windowed", KEYS).collect())


T = 1_700_000_010


def test_backfill_never_replaces_a_stream_batch(spark):
    from tickflow.streaming.jobs import run_backfill

    root = scratch_path(spark, "mix")
    _stream(spark, [("A", 1.0, T), ("B", 2.0, T)], root, "a")
    run_backfill(_ticks(spark, [("C", 3.0, T), ("D", 4.0, T)]), root, batch_id=0, kv=False)
    assert _prices(spark, root) == [("A", 1.0), ("B", 2.0), ("C", 3.0), ("D", 4.0)]


@pytest.mark.parametrize("keep_latest", [0, 1])
def test_backfill_after_compaction_and_rerun(spark, keep_latest):
    from tickflow.streaming.jobs import fold_tables, run_backfill

    root = scratch_path(spark, "mix")
    _stream(spark, [("A", 1.0, T), ("B", 2.0, T)], root, "a")
    fold_tables(spark, root, keep_latest)
    run_backfill(_ticks(spark, [("C", 3.0, T)]), root, batch_id=0, kv=False)
    assert _prices(spark, root) == [("A", 1.0), ("B", 2.0), ("C", 3.0)]
    run_backfill(_ticks(spark, [("D", 4.0, T)]), root, batch_id=0, kv=False)  # the same id replaces
    assert _prices(spark, root) == [("A", 1.0), ("B", 2.0), ("D", 4.0)]


def test_high_backfill_id_hides_no_later_stream_batch(spark):
    from tickflow.streaming.jobs import fold_tables, run_backfill

    root = scratch_path(spark, "mix")
    run_backfill(_ticks(spark, [("A", 1.0, T), ("B", 2.0, T)]), root, batch_id=900, kv=False)
    fold_tables(spark, root, keep_latest=0)
    _stream(spark, [("A", 5.0, T), ("C", 3.0, T)], root, "a")
    assert _prices(spark, root) == [("A", 5.0), ("B", 2.0), ("C", 3.0)]


def test_new_checkpoint_adds_to_the_table(spark):
    from tickflow.operators.views import read_latest
    from tickflow.streaming.jobs import fold_tables

    root = scratch_path(spark, "mix")
    _stream(spark, [("A", 1.0, T), ("B", 2.0, T)], root, "a")
    fold_tables(spark, root, keep_latest=0)
    _stream(spark, [("A", 7.0, T), ("C", 3.0, T)], root, "b")
    assert _prices(spark, root) == [("A", 7.0), ("B", 2.0), ("C", 3.0)]
    assert sorted((r.symbol, r.avg_price) for r in read_latest(spark, f"{root}/windowed/views").collect()) == _prices(spark, root)


def test_work_dir_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from tickflow.session import work_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(Session())
