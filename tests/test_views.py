"""Incremental "latest" views equal the panels over the whole stored table."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickflow.operators.store import latest_by_key, upsert
from tickflow.operators.views import fold_views, put_views, read_latest, read_newest
from tickflow.plans import reports as R
from tickflow.session import scratch_path

SCHEMA = (
    "symbol string, window_start timestamp_ntz, window_end timestamp_ntz, avg_price double, "
    "min_price double, max_price double, total_volume double, updated_at timestamp_ntz"
)
KEYS = ["symbol", "window_start"]
T0 = dt.datetime(2024, 1, 1)
N = 3  # small, so candidates really drop rows

# One batch: (key index, write-time step >= 0, price) per updated key.
batch_st = st.lists(
    st.tuples(st.integers(0, 11), st.integers(0, 2), st.integers(1, 50)), min_size=1, max_size=8
)


def _rows(batch, last):
    rows, seen = [], set()
    for k, step, price in batch:
        if k in seen:  # a batch emits each key once
            continue
        seen.add(k)
        sym, ws = "ABC"[k % 3], T0 + dt.timedelta(hours=k // 3)
        # A key's write time never decreases; step 0 repeats it (a tie).
        last[k] = max(last.get(k, T0), ws) + dt.timedelta(minutes=step)
        p = float(price)
        rows.append((sym, ws, ws + dt.timedelta(hours=1), p, p - 1, p + 1, p * 2, last[k]))
    return rows


def _panels(latest, newest):
    return (
        sorted(map(tuple, R.latest_avg_price(latest).collect())),
        sorted(map(tuple, R.latest_total_volume(latest).collect())),
        sorted(map(tuple, R.freshness_seconds(latest, "2024-01-02 00:00:00").collect())),
        [tuple(r) for r in R.latest_rows(newest, N).collect()],
    )


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(batch_st, min_size=1, max_size=4))
def test_views_equal_full_table_panels(spark, batches):
    path = scratch_path(spark, "views")
    last = {}
    for b, batch in enumerate(batches):
        df = spark.createDataFrame(_rows(batch, last), SCHEMA)
        upsert(df, path, b)
        put_views(df, f"{path}/views", b, n=N)
    table = latest_by_key(spark, path, KEYS)
    expect = _panels(table, table)
    assert _panels(read_latest(spark, f"{path}/views"), read_newest(spark, f"{path}/views", N)) == expect
    fold_views(spark, f"{path}/views", keep_latest=0)
    assert _panels(read_latest(spark, f"{path}/views"), read_newest(spark, f"{path}/views", N)) == expect


def test_backfill_keeps_views_of_its_tables(spark):
    from paths import SF_SMALL
    from tickflow.plans.registry import trades
    from tickflow.streaming.jobs import run_backfill

    root = scratch_path(spark, "backfill-views")
    run_backfill(trades(spark, SF_SMALL), root, 0, kv=False)
    for name, keys in [("windowed", KEYS), ("anomalies", KEYS)]:
        table = latest_by_key(spark, f"{root}/{name}", keys)
        latest = read_latest(spark, f"{root}/{name}/views")
        assert sorted(map(tuple, latest.collect())) == sorted(map(tuple, R.latest_per_symbol(table, table.columns).collect()))
    w = latest_by_key(spark, f"{root}/windowed", KEYS)
    newest = read_newest(spark, f"{root}/windowed/views")
    assert R.latest_rows(newest, 50).collect() == R.latest_rows(w, 50).collect()


def test_fold_tables_keeps_every_read(spark):
    from pyspark.sql import functions as F

    from paths import SF_SMALL
    from tickflow.operators.kv import read_kv
    from tickflow.plans.registry import dimension_fixture, trades
    from tickflow.streaming.jobs import fold_tables, run_backfill

    root = scratch_path(spark, "fold-all")
    t = trades(spark, SF_SMALL)
    run_backfill(t.where(F.col("timestamp") < F.lit("2024-01-15").cast("timestamp_ntz")), root, 0,
                 meta=dimension_fixture(spark))
    run_backfill(t, root, 1, meta=dimension_fixture(spark))

    def snapshot():
        return (
            sorted(map(tuple, latest_by_key(spark, f"{root}/windowed", KEYS).drop("updated_at").collect())),
            sorted(map(tuple, latest_by_key(spark, f"{root}/moving_avg", KEYS + ["window_end"]).drop("updated_at").collect())),
            sorted(map(tuple, read_latest(spark, f"{root}/anomalies/views").drop("updated_at").collect())),
            [tuple(r)[1:] for r in R.latest_rows(read_newest(spark, f"{root}/windowed/views"), 50).collect()],
            sorted((r.row_key, sorted(r.cells.items())) for r in read_kv(spark, f"{root}/kv_windowed").collect()),
        )

    before = snapshot()
    done = fold_tables(spark, root, keep_latest=0)
    assert done["windowed"] == 2 and done["kv_windowed"] == 4
    assert snapshot() == before


def test_newest_rows_of_a_subset_and_too_many(spark):
    import pytest

    path = scratch_path(spark, "views")
    hour = dt.timedelta(hours=1)
    rows = [(s, T0 + i * hour, T0 + (i + 1) * hour, 1.0, 1.0, 1.0, 1.0, T0 + i * hour + dt.timedelta(minutes=m))
            for m, (s, n) in enumerate([("A", 40), ("B", 5), ("C", 8)]) for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    upsert(df, path, 0)
    put_views(df, f"{path}/views", 0, n=6)
    fold_views(spark, f"{path}/views", keep_latest=0)
    table = latest_by_key(spark, path, KEYS)
    for subset in (None, ["B", "C"], ["C"], ["Z"]):
        newest = read_newest(spark, f"{path}/views", 6, subset)
        assert R.latest_rows(newest, 6, subset).collect() == R.latest_rows(table, 6, subset).collect()
    with pytest.raises(ValueError, match="keeps 6 rows"):
        read_newest(spark, f"{path}/views", 7)
