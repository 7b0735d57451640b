"""Stream == batch for arbitrary splits of the input into micro-batches."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paths import SF_SMALL
from tickflow.operators.store import latest_by_key
from tickflow.operators.windows import window_stats
from tickflow.plans.registry import trades as batch_trades
from tickflow.session import scratch_path
from tickflow.sources.codec import decode_trades, with_trade_time
from tickflow.sources.files import read_file_trades, stage_replay
from tickflow.sources.testdata import events_as_messages, load_table
from tickflow.streaming.jobs import start_query, store_writer
from tickflow.streaming.replay import AVAILABLE_NOW, run_until_done

COLS = ["symbol", "window_start", "window_end", "avg_price", "min_price", "max_price", "total_volume"]
# events at sf0.001 span 2024-01-01 .. 2024-01-30 (epoch ms)
T_MIN, T_MAX = 1704067200000, 1706659200000


def _norm(df):
    return sorted(
        tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*COLS).collect()
    )


def _stream_table(spark, seq_col, n_files, watermark):
    path = scratch_path(spark, "prop")
    msgs = events_as_messages(load_table(spark, SF_SMALL, "events"), keep_ts=True).withColumn("seq", seq_col)
    stage_replay(msgs, f"{path}/in", n_files, "seq")
    stream = with_trade_time(
        decode_trades(read_file_trades(spark, f"{path}/in"), fields=["symbol", "price", "quantity", "event_time"]),
        "event_time",
    )
    q = start_query(window_stats(stream, "1 hour", watermark=watermark), "prop", store_writer(f"{path}/w", ["symbol", "window_start"]),
                    f"{path}/ckpt", trigger=AVAILABLE_NOW)
    run_until_done(q)
    return latest_by_key(spark, f"{path}/w", ["symbol", "window_start"])


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(T_MIN, T_MAX), min_size=1, max_size=4, unique=True))
def test_time_ordered_split_equals_batch(spark, cuts):
    cuts = sorted(cuts)
    seq = F.lit(0)
    for c in cuts:
        seq = seq + (F.col("ts") >= F.lit(c)).cast("int")
    streamed = _stream_table(spark, seq, len(cuts) + 1, "1 minute")
    assert _norm(streamed) == _norm(window_stats(batch_trades(spark, SF_SMALL), "1 hour"))


@settings(max_examples=2, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(2, 5), st.integers(0, 1000))
def test_any_split_with_long_watermark_equals_batch(spark, n, salt):
    seq = F.pmod(F.xxhash64(F.col("value"), F.lit(salt)), F.lit(n))
    streamed = _stream_table(spark, seq, n, "31 days")
    assert _norm(streamed) == _norm(window_stats(batch_trades(spark, SF_SMALL), "1 hour"))
