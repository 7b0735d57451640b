import datetime as dt

from pyspark.sql import functions as F

from tickflow.operators.kv import (
    cells_of,
    decode_kv_anomalies,
    merge_cells,
    put_kv,
    read_kv,
    scan_prefix,
    to_kv_anomalies,
    to_kv_windowed,
)
from tickflow.plans import reports as R
from tickflow.session import scratch_path

T = dt.datetime(2024, 1, 1, 12, 0, 30)


def _puts(spark, rows):
    return spark.createDataFrame([r[:2] for r in rows], "row_key string, cells map<string,string>")


def test_cell_merge_union_later_wins(spark):
    puts = [{"price:avg": "1.0", "volume:total": "5.0"}, {"price:avg": "2.0", "price:status": "NORMAL", "gone": None}]
    first, second = (
        cells_of(_puts(spark, [("A_1", p)])).withColumns({"version": F.lit(i).cast("long"), "writer": F.lit("w")})
        for i, p in enumerate(puts)
    )
    cells = merge_cells(second.unionByName(first)).first().cells
    assert cells == {"price:avg": "2.0", "volume:total": "5.0", "price:status": "NORMAL"}


def test_prefix_collision_and_exact(spark):
    kv = _puts(spark, [("AB_1", {"x": "1"}, 0), ("ABC_1", {"x": "2"}, 0), ("B_1", {"x": "3"}, 0)])
    assert [r.row_key for r in scan_prefix(kv, "AB").collect()] == ["ABC_1", "AB_1"]
    assert [r.row_key for r in scan_prefix(kv, "AB", exact=True).collect()] == ["AB_1"]


def test_row_key_and_cell_text(spark):
    df = spark.createDataFrame(
        [("BTCUSD", T, 1.23456789, 1.0, 2.0, 3.0, 12.5, True)],
        "symbol string, window_start timestamp_ntz, avg_price double, min_price double, max_price double, "
        "total_volume double, price_range_pct double, is_anomaly boolean",
    )
    w = to_kv_windowed(df).first()
    assert w.row_key == "BTCUSD_2024-01-01 12:00:30"
    assert w.cells["price:avg"] == "1.234568"
    a = to_kv_anomalies(df).first()
    assert a.cells["alert:is_anomaly"] == "True"


def test_decode_defaults(spark):
    kv = _puts(spark, [("A_2024-01-01 00:00:00", {"price:avg": "1.5"}, 0)])
    r = decode_kv_anomalies(kv, "A").first()
    assert r.window == "2024-01-01 00:00:00" and r.avg_price == 1.5 and r.max_price == 0.0
    assert r.is_anomaly == "False"


def test_put_read_scan_roundtrip_and_reports(spark):
    path = scratch_path(spark, "kv")
    rows = [(f"A_2024-01-01 00:00:{i:02d}", {"price:avg": str(float(i)), "alert:is_anomaly": "True" if i % 2 else "False"}, 0)
            for i in range(30)]
    put_kv(_puts(spark, rows), path, 0)
    put_kv(_puts(spark, [("A_2024-01-01 00:00:00", {"price:avg": "99.0"}, 0)]), path, 1)
    kv = read_kv(spark, path)
    scan = scan_prefix(kv, "A")
    keys = [r.row_key for r in scan.collect()]
    assert len(keys) == 20 and keys == sorted(keys)
    kpi = R.kpi_scan(kv, "A").first()
    assert kpi.window == "2024-01-01 00:00:19" and kpi.avg_price == 19.0  # 20th-oldest, as upstream
    assert R.scan_prices(kv, "A").first().avg_price == 99.0
    assert R.scan_anomaly_count(kv, "A").first().anomaly_count == 10
    plan = scan._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    assert "StringStartsWith(row_key,A)" in pushed


def test_scan_moving_avg_first_per_window(spark):
    kv = _puts(spark, [
        ("A_2024-01-01 00:00:00_2024-01-01 00:02:00", {"price:moving_avg": "1.0"}, 0),
        ("A_2024-01-01 00:00:30_2024-01-01 00:02:30", {"price:moving_avg": "2.0"}, 0),
    ])
    out = R.scan_moving_avg(kv, "A").collect()
    assert [(r.window, r.moving_avg_price) for r in out] == [
        ("2024-01-01 00:00:00_2024-01-01 00:02:00", 1.0),
        ("2024-01-01 00:00:30_2024-01-01 00:02:30", 2.0),
    ]


def test_two_writers_same_batch_id_do_not_clobber(spark):
    path = scratch_path(spark, "kv")
    put_kv(_puts(spark, [("A_1", {"price:avg": "1.0", "volume:total": "5.0"}, 0)]), path, 0, "windowed")
    put_kv(_puts(spark, [("A_1", {"price:avg": "2.0", "price:status": "NORMAL"}, 0)]), path, 0, "enriched")
    # retry of the first writer's batch 0 rewrites only its own puts (and is now the newest)
    put_kv(_puts(spark, [("A_1", {"price:avg": "1.0", "volume:total": "5.0"}, 0)]), path, 0, "windowed")
    cells = read_kv(spark, path).first().cells
    assert cells == {"price:avg": "1.0", "volume:total": "5.0", "price:status": "NORMAL"}


def test_read_metadata_csv(spark):
    from tickflow.plans.registry import DIMENSION_FIXTURE
    from tickflow.sources.files import metadata_frame, read_metadata, write_metadata

    path = scratch_path(spark, "meta") + "/dimension"
    write_metadata(metadata_frame(spark, DIMENSION_FIXTURE), path)
    meta = read_metadata(spark, path)
    assert sorted(map(tuple, meta.collect())) == sorted(DIMENSION_FIXTURE)
    assert dict(meta.dtypes)["launched_year"] == "int"


def test_fold_kv_keeps_merge_semantics(spark):
    from tickflow.operators.kv import fold_kv

    path = scratch_path(spark, "kv")
    for seq in range(3):
        put_kv(_puts(spark, [("A_1", {"price:avg": str(float(seq)), f"c{seq}": "x"}, 0)]),
               path, seq, "windowed")
    put_kv(_puts(spark, [("A_1", {"price:status": "NORMAL"}, 0), ("B_1", {"price:avg": "7.0"}, 0)]),
           path, 0, "enriched")
    before = {r.row_key: r.cells for r in read_kv(spark, path).collect()}
    assert fold_kv(spark, path) == 2  # folds windowed 0-1; keeps windowed 2 and enriched 0
    assert {r.row_key: r.cells for r in read_kv(spark, path).collect()} == before
    put_kv(_puts(spark, [("A_1", {"price:avg": "9.0"}, 0)]), path, 3, "windowed")
    assert fold_kv(spark, path) == 1
    after = {r.row_key: r.cells for r in read_kv(spark, path).collect()}
    assert after["A_1"]["price:avg"] == "9.0" and after["A_1"]["c0"] == "x" and after["A_1"]["price:status"] == "NORMAL"
    assert after["B_1"] == {"price:avg": "7.0"}


def test_fold_leaves_the_newest_batch(spark):
    import datetime as dt

    from tickflow.operators.store import fold, latest_by_key, upsert

    path = scratch_path(spark, "store")
    t = dt.datetime(2024, 1, 1)
    for b in range(3):
        upsert(spark.createDataFrame([("A", t, float(b))], "symbol string, window_start timestamp_ntz, v double"),
               path, b)
    assert fold(spark, path, ["symbol", "window_start"]) == 2
    # re-running the newest batch (a restart) still lands in a partition that is read
    upsert(spark.createDataFrame([("A", t, 2.0)], "symbol string, window_start timestamp_ntz, v double"), path, 2)
    assert latest_by_key(spark, path, ["symbol", "window_start"]).first().v == 2.0


def test_cell_merge_shuffles_once(spark):
    path = scratch_path(spark, "kv")
    put_kv(_puts(spark, [("A_1", {"x": "1"}), ("B_1", {"x": "2", "y": "3"})]), path, 0)
    put_kv(_puts(spark, [("A_1", {"x": "4"})]), path, 1)
    merged = read_kv(spark, path)
    assert {r.row_key: r.cells for r in merged.collect()} == {"A_1": {"x": "4"}, "B_1": {"x": "2", "y": "3"}}
    plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange") - plan.count("ReusedExchange") == 1, plan
