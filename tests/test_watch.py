"""Late ticks, failing siblings, open windows, rejected messages, the dimension as CSV."""

import datetime as dt

import pytest
from paths import SF_SMALL
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tickflow.operators.store import latest_by_key, read_log
from tickflow.operators.windows import window_stats
from tickflow.plans import registry_streams as Q
from tickflow.plans.registry import dimension_fixture
from tickflow.plans.registry import trades as batch_trades
from tickflow.session import scratch_path
from tickflow.sources.codec import CORRUPT_COLUMN, decode_trades, encode_trades, with_trade_time
from tickflow.sources.files import read_file_trades, read_metadata, stage_replay, write_metadata
from tickflow.streaming.jobs import split_writer, start_query, store_writer
from tickflow.streaming.replay import AVAILABLE_NOW, replay_events, run_until_done
from tickflow.streaming.watch import TickAccount, counted_input, open_windows, run_together

KEYS = ["symbol", "window_start"]
FIELDS = ["symbol", "price", "quantity", "event_time"]
HOUR = 3_600_000


def _stream(spark, rows, n_files):
    """rows: (turn, symbol, price, epoch ms) -> staged files in turn."""
    path = scratch_path(spark, "watch")
    df = spark.createDataFrame(rows, "seq long, symbol string, price double, event_time long").withColumn("quantity", F.lit(1.0))
    stage_replay(encode_trades(df, keep=["seq"]), f"{path}/in", n_files, "seq")
    return with_trade_time(decode_trades(read_file_trades(spark, f"{path}/in")), "event_time"), path


def _table(df, cols):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


def test_account_adds_up(spark):
    t = 500_000 * HOUR
    # Late from two batches after the watermark passed; two ticks of one window in one batch are one group.
    rows = [(0, "A", 1.0, t), (1, "A", 2.0, t + 5 * HOUR), (2, "B", 1.0, t + 5 * HOUR), (3, "A", 3.0, t), (3, "A", 4.0, t + 1), (4, "B", 9.0, t)]
    ticks, path = _stream(spark, rows, 5)
    account = TickAccount("account")
    spark.streams.addListener(account)
    try:
        stats = window_stats(counted_input(ticks), "1 hour", "1 minute", count=True)
        run_until_done(start_query(stats, "account", store_writer(f"{path}/w", KEYS), f"{path}/ckpt", trigger=AVAILABLE_NOW))
        account.wait()
    finally:
        spark.streams.removeListener(account)
    kept = latest_by_key(spark, f"{path}/w", KEYS).agg(F.sum("n_ticks")).first()[0]
    assert account.total("ticks") == 6 and kept == 3
    assert account.total("late_groups") == 2
    marks = [b["watermark"] for _, b in sorted(account.batches.items())]
    assert marks == sorted(marks) and len(set(marks)) > 1


def test_registered_account_sees_late_ticks(spark):
    row = Q.q_stream_late_account(spark, SF_SMALL).first()
    assert row.read_ticks == row.kept_ticks + row.dropped_ticks and row.dropped_ticks > 0
    assert 0 < row.dropped_groups <= row.dropped_ticks


def test_open_windows_agree_with_the_last_output(spark):
    trades, root = replay_events(spark, SF_SMALL, 3, FIELDS)
    stats = window_stats(trades, "1 hour", watermark="3 days")
    run_until_done(start_query(stats, "open", store_writer(f"{root}/w", KEYS), f"{root}/ckpt", trigger=AVAILABLE_NOW))
    held = open_windows(spark, f"{root}/ckpt")
    stored = latest_by_key(spark, f"{root}/w", KEYS)
    last = batch_trades(spark, SF_SMALL).agg(F.max("timestamp")).first()[0]
    want = stored.where(F.col("window_end") > F.lit(last - dt.timedelta(days=3)).cast("timestamp_ntz"))
    cols = ["symbol", "window_start", "window_end", "avg_price", "min_price", "max_price", "total_volume"]
    assert held.columns == cols
    assert _table(held, cols) == _table(want, cols) and 0 < held.count() < stored.count()


def test_failing_query_stops_its_siblings_and_all_restart(spark):
    root = scratch_path(spark, "siblings")
    broken = [True]
    trades, staged = replay_events(spark, SF_SMALL, 3, FIELDS)

    def start(trigger):
        write = store_writer(f"{root}/bad", KEYS)

        def fails(batch, batch_id):
            if broken and batch_id == 1:
                raise RuntimeError("disk full")
            write(batch, batch_id)

        stats = window_stats(trades, "1 hour", "1 minute")
        good = start_query(stats, "good_sibling", store_writer(f"{root}/good", KEYS), f"{root}/ckpt-good", trigger=trigger)
        return [good, start_query(stats, "bad_sibling", fails, f"{root}/ckpt-bad", trigger=trigger)]

    queries = start({"processingTime": "1 second"})  # would run for ever
    with pytest.raises(StreamingQueryException, match="disk full"):
        run_together(spark, queries)
    assert not any(q.isActive for q in queries)
    spark.streams.resetTerminated()
    broken.clear()
    run_together(spark, start(AVAILABLE_NOW))
    cols = ["symbol", "window_start", "avg_price", "min_price", "max_price", "total_volume"]
    want = _table(window_stats(batch_trades(spark, SF_SMALL), "1 hour"), cols)
    assert _table(latest_by_key(spark, f"{root}/good", KEYS), cols) == want == _table(latest_by_key(spark, f"{root}/bad", KEYS), cols)


def test_rejected_messages_keep_their_text_and_a_retry_replaces_them(spark):
    path = scratch_path(spark, "split")
    texts = ['{"symbol":"A","price":1.5,"event_time":1700000000000}', "oops", '{"symbol":"B","price":"x"}', '{"price":3}', '{"symbol":null,"price":null}']
    batch = decode_trades(spark.createDataFrame([(t,) for t in texts], "value string"), fields=FIELDS, keep_corrupt=True)
    write = split_writer(f"{path}/good", f"{path}/bad")
    for _ in range(2):
        write(batch.persist(), 0)
    good, bad = read_log(spark, f"{path}/good"), read_log(spark, f"{path}/bad")
    assert [(r.symbol, r.price) for r in good.collect()] == [("A", 1.5)] and CORRUPT_COLUMN not in good.columns
    rejected = {(r.symbol, r.price, r[CORRUPT_COLUMN]) for r in bad.collect()}
    assert rejected == {(None, None, "oops"), ("B", None, '{"symbol":"B","price":"x"}'), (None, 3.0, None), (None, None, None)}
    assert bad.count() == 4


def test_metadata_csv_checks_header_and_types(spark):
    path = scratch_path(spark, "meta")
    meta = dimension_fixture(spark)
    write_metadata(meta, f"{path}/ok")
    assert sorted(map(tuple, read_metadata(spark, f"{path}/ok").collect())) == sorted(map(tuple, meta.collect()))
    first, second, *others = meta.columns
    write_metadata(meta.select(second, first, *others), f"{path}/swapped")
    with pytest.raises(Exception, match="(?i)header"):
        read_metadata(spark, f"{path}/swapped").collect()
    header = ",".join(meta.columns)
    lines = [header, "A,Alpha,Large,Tech,X,2009", "B,Beta,Small,Tech,X,long ago"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{path}/typed")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_metadata(spark, f"{path}/typed").collect()
    rows = {r.symbol: r for r in read_metadata(spark, f"{path}/typed", keep_corrupt=True).collect()}
    assert rows["A"].launched_year == 2009 and rows["A"][CORRUPT_COLUMN] is None
    assert rows["B"].launched_year is None and "long ago" in rows["B"][CORRUPT_COLUMN]
