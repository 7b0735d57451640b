import datetime as dt
import sqlite3

import pytest
from pyspark.sql import functions as F

from tickflow.operators import store
from tickflow.operators.store import fold, latest_by_key, read_log, upsert, upsert_dbapi
from tickflow.session import scratch_path

SCHEMA = "symbol string, window_start timestamp_ntz, avg_price double"
T = dt.datetime(2024, 1, 1)


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _table(df):
    return sorted((r.symbol, r.window_start, r.avg_price) for r in df.collect())


def test_upsert_latest_and_retry(spark):
    path = scratch_path(spark, "store")
    upsert(_rows(spark, [("A", T, 1.0), ("B", T, 2.0)]), path, 0)
    upsert(_rows(spark, [("A", T, 3.0)]), path, 1)
    keys = ["symbol", "window_start"]
    first = _table(latest_by_key(spark, path, keys))
    assert first == [("A", T, 3.0), ("B", T, 2.0)]
    # A retried batch rewrites its own partition: table unchanged.
    upsert(_rows(spark, [("A", T, 3.0)]), path, 1)
    assert _table(latest_by_key(spark, path, keys)) == first
    assert read_log(spark, path).count() == 3


def test_fold_keeps_answers_and_later_batches_win(spark):
    path = scratch_path(spark, "store")
    keys = ["symbol", "window_start"]
    for b, v in enumerate([1.0, 2.0, 3.0]):
        upsert(_rows(spark, [("A", T, v), ("B", T + dt.timedelta(hours=b), v)]), path, b)
    before = _table(latest_by_key(spark, path, keys))
    assert fold(spark, path, keys, keep_latest=0) == 3
    assert _table(latest_by_key(spark, path, keys)) == before
    assert read_log(spark, path).count() == 4  # folded rows only
    assert fold(spark, path, keys, keep_latest=0) == 0  # nothing new: deletes what the first one replaced
    assert _table(latest_by_key(spark, path, keys)) == before
    assert read_log(spark, path).count() == 4  # folded rows only
    upsert(_rows(spark, [("A", T, 9.0)]), path, 3)
    after = dict(((s, w), v) for s, w, v in _table(latest_by_key(spark, path, keys)))
    assert after[("A", T)] == 9.0
    assert fold(spark, path, keys, keep_latest=0) == 1


def test_retried_batch_with_other_days_leaves_none_of_its_old_rows(spark):
    path = scratch_path(spark, "store")
    _days(spark, path, [0, 1], 1.0, 0)
    _days(spark, path, [5], 9.0, 1)
    _days(spark, path, [1, 2], 2.0, 0)
    assert {(w - T).days: v for _, w, v in _table(latest_by_key(spark, path, KEYS))} == {1: 2.0, 2: 2.0, 5: 9.0}


def test_a_fold_that_dies_before_it_marks_is_repeated(spark, monkeypatch):
    path = scratch_path(spark, "store")
    for b in range(3):
        _days(spark, path, [0, b], float(b), b)
    fold(spark, path, KEYS)
    _days(spark, path, [0, 7], 7.0, 7)
    before = _table(latest_by_key(spark, path, KEYS))
    real = store._fs

    def dies(session, where):
        if "/folded/" in where and "*" not in where:
            raise RuntimeError("driver lost")
        return real(session, where)

    monkeypatch.setattr(store, "_fs", dies)
    with pytest.raises(RuntimeError, match="driver lost"):
        fold(spark, path, KEYS)
    monkeypatch.setattr(store, "_fs", real)
    assert _table(latest_by_key(spark, path, KEYS)) == before
    for _ in range(3):
        fold(spark, path, KEYS, keep_latest=0)
        assert _table(latest_by_key(spark, path, KEYS)) == before


def test_upsert_dbapi_sqlite(spark, tmp_path):
    db = str(tmp_path / "t.db")
    con = sqlite3.connect(db)
    con.execute(
        "CREATE TABLE w (symbol TEXT, window_start TEXT, avg_price REAL, updated_at TEXT, "
        "PRIMARY KEY (symbol, window_start))"
    )
    con.commit()
    con.close()

    def connect(path=db):
        import sqlite3 as s

        return s.connect(path, timeout=30)

    df = spark.createDataFrame([("A", "2024-01-01 00:00:00", 1.0), ("B", "2024-01-01 00:00:00", 2.0)],
                               "symbol string, window_start string, avg_price double").coalesce(1)
    upsert_dbapi(df, connect, "w", ["symbol", "window_start"])
    df2 = spark.createDataFrame([("A", "2024-01-01 00:00:00", 5.0)], "symbol string, window_start string, avg_price double")
    upsert_dbapi(df2, connect, "w", ["symbol", "window_start"])
    upsert_dbapi(df2, connect, "w", ["symbol", "window_start"])  # retry is harmless
    rows = sqlite3.connect(db).execute("SELECT symbol, avg_price, updated_at IS NOT NULL FROM w ORDER BY 1").fetchall()
    assert rows == [("A", 5.0, 1), ("B", 2.0, 0)]


def test_since_prunes_before_the_merge_without_changing_answers(spark):
    path = scratch_path(spark, "store")
    keys = ["symbol", "window_start"]
    schema = "symbol string, window_start timestamp_ntz, avg_price double, updated_at timestamp_ntz"
    h = dt.timedelta(hours=1)
    # A: old version before the bound, newer after it.  B: only before.  C: only after.
    upsert(spark.createDataFrame([("A", T, 1.0, T), ("B", T, 2.0, T)], schema), path, 0)
    upsert(spark.createDataFrame([("A", T, 5.0, T + 2 * h), ("C", T, 7.0, T + 3 * h)], schema), path, 1)
    since = (T + h).strftime("%Y-%m-%d %H:%M:%S")
    full = latest_by_key(spark, path, keys)
    pruned = latest_by_key(spark, path, keys, since=since)
    expect = sorted(tuple(r) for r in full.where(f"updated_at >= '{since}'").collect())
    assert sorted(tuple(r) for r in pruned.collect()) == expect
    assert [(r[0], r[2]) for r in expect] == [("A", 5.0), ("C", 7.0)]
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(updated_at" in plan  # reaches the parquet scan
    fold(spark, path, keys, keep_latest=0)
    assert sorted(tuple(r) for r in latest_by_key(spark, path, keys, since=since).collect()) == expect


KEYS = ["symbol", "window_start"]
STAMPED = SCHEMA + ", updated_at timestamp_ntz"
DAY = dt.timedelta(days=1)


def _days(spark, path, days, value, batch, **kw):
    upsert(_rows(spark, [(s, T + d * DAY, value) for d in days for s in "AB"]), path, batch, KEYS, **kw)


def _files(spark, path):
    read = read_log(spark, path).select(F.input_file_name()).distinct().collect()  # after the skipped folders are pruned
    return {r[0].rsplit("/base/", 1)[1] for r in read if "/base/" in r[0]}


def test_read_that_began_before_a_fold_finds_every_row(spark):
    path = scratch_path(spark, "store")
    for b in range(4):
        _days(spark, path, [b], float(b), b)
    opened = latest_by_key(spark, path, KEYS)  # its files are listed now
    before = _table(latest_by_key(spark, path, KEYS))
    fold(spark, path, KEYS)
    assert _table(opened) == before == _table(latest_by_key(spark, path, KEYS))
    _days(spark, path, [4], 4.0, 4)
    opened = latest_by_key(spark, path, KEYS)
    before = _table(latest_by_key(spark, path, KEYS))
    fold(spark, path, KEYS)  # deletes what the first fold had replaced, nothing that is still read
    assert _table(opened) == before == _table(latest_by_key(spark, path, KEYS))


def test_a_batch_that_is_not_committed_is_not_read(spark):
    path = scratch_path(spark, "store")
    _days(spark, path, [0], 1.0, 0)
    # Another batch as during its write: files only where the committer keeps them.
    spark.createDataFrame([(1,)], "other int").write.parquet(f"{path}/log/w_=stream/e_=0/b_=1/v_=99/_temporary/0/task/day_=d2024-01-01")
    assert latest_by_key(spark, path, KEYS).count() == 2


def test_first_read_needs_no_files_with_a_schema(spark):
    from pyspark.sql import types as types

    schema = types.StructType.fromDDL(SCHEMA)
    assert latest_by_key(spark, scratch_path(spark, "none"), KEYS, schema=schema).count() == 0


def test_fold_rewrites_only_touched_days(spark):
    path = scratch_path(spark, "store")
    _days(spark, path, range(5), 1.0, 0)
    fold(spark, path, KEYS, keep_latest=0)
    old = _files(spark, path)
    assert {f.split("/")[0] for f in old} == {"slot_=0"} and len(old) == 5
    _days(spark, path, [4, 5], 2.0, 1)
    fold(spark, path, KEYS, keep_latest=0)
    new = _files(spark, path)
    assert {f for f in old if "2024-01-05" not in f} == {f for f in new if f in old}
    assert all(store._exists(spark, f"{path}/base/{f}") for f in old)  # for reads that began before
    assert {"/".join(f.split("/")[:2]) for f in new - old} == {"slot_=1/day_=d2024-01-05", "slot_=0/day_=d2024-01-06"}
    assert [v for _, w, v in _table(latest_by_key(spark, path, KEYS)) if w >= T + 4 * DAY] == [2.0] * 4
    fold(spark, path, KEYS, keep_latest=0)
    assert [f for f in old if not store._exists(spark, f"{path}/base/{f}")] == [f for f in old if "2024-01-05" in f]


def test_last_hour_reads_only_the_last_day_after_fold(spark):
    path = scratch_path(spark, "store")
    for b in range(6):
        rows = [(s, T + b * DAY, 1.0, T + b * DAY) for s in "AB"]
        upsert(spark.createDataFrame(rows, STAMPED), path, b)
    fold(spark, path, KEYS, keep_latest=0)
    plan = latest_by_key(spark, path, KEYS, since="2024-01-05 23:30:00")
    assert plan.count() == 2 and "GreaterThanOrEqual(updated_at" in plan._jdf.queryExecution().executedPlan().toString()
    touched = [f for f in _files(spark, path) if spark.read.parquet(f"{path}/base/{f}").where("updated_at >= '2024-01-05 23:30:00'").count()]
    assert len(touched) == 1 and "day_=d2024-01-06" in touched[0]


def test_table_since_and_view_agree_on_the_current_version(spark):
    from tickflow.operators.views import put_views, read_latest

    path = scratch_path(spark, "store")
    for batch_id, (value, minute) in ((7, (1.0, 30)), (2, (5.0, 10))):  # a lower id written later, with an older stamp
        rows = spark.createDataFrame([("A", T, value, T + dt.timedelta(minutes=minute))], STAMPED)
        upsert(rows, path, batch_id, writer=f"w{batch_id}")
        put_views(rows, f"{path}/views", batch_id, writer=f"w{batch_id}")
    table = latest_by_key(spark, path, KEYS).first().avg_price
    since = latest_by_key(spark, path, KEYS, since="2024-01-01 00:20:00").first().avg_price
    assert table == since == read_latest(spark, f"{path}/views").first().avg_price == 1.0


def test_dbapi_connections_are_bounded(spark, tmp_path):
    seen = str(tmp_path)

    def connect(folder=seen):
        import os
        import sqlite3 as s
        import uuid

        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        con = s.connect(":memory:")
        con.execute("CREATE TABLE w (symbol TEXT PRIMARY KEY, v REAL)")
        return con

    def send(cursor, sql, rows):
        cursor.executemany(sql, rows)

    df = spark.createDataFrame([(f"s{i}", 1.0) for i in range(64)], "symbol string, v double").repartition(16)
    upsert_dbapi(df, connect, "w", ["symbol"], touch=None, max_connections=3, send=send)
    assert 1 <= len(list(tmp_path.iterdir())) <= 3
