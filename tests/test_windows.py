import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from tickflow.functions.prices import label_status
from tickflow.operators.enrich import enrich
from tickflow.operators.windows import interval_micros, moving_average, range_anomalies, window_stats
from tickflow.schema import METADATA

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _ticks(spark, rows):
    return spark.createDataFrame(
        [(s, p, q, T0 + dt.timedelta(seconds=sec)) for s, p, q, sec in rows],
        "symbol string, price double, quantity double, timestamp timestamp_ntz",
    )


def test_interval_micros():
    assert interval_micros("30 seconds") == 30_000_000
    assert interval_micros("2 minutes") == 120_000_000
    assert interval_micros("1 hour") == 3_600_000_000


def test_zero_mean_gives_null_pct_and_no_anomaly(spark):
    out = range_anomalies(_ticks(spark, [("A", 0.0, 1.0, 1), ("A", 0.0, 1.0, 2)])).collect()
    assert len(out) == 1
    assert out[0].price_range_pct is None and out[0].is_anomaly is False


def test_threshold_is_strict(spark):
    # max-min = 0.5, avg = 100 -> pct exactly 0.5
    out = range_anomalies(_ticks(spark, [("A", 99.75, 1.0, 1), ("A", 100.25, 1.0, 2)])).first()
    assert out.price_range_pct == 0.5 and out.is_anomaly is False
    above = range_anomalies(_ticks(spark, [("A", 99.75, 1.0, 1), ("A", 100.2500001, 1.0, 2)])).first()
    assert above.price_range_pct > 0.5 and above.is_anomaly is True


def test_window_durations():
    import pytest

    from tickflow.operators.windows import interval_micros

    assert interval_micros("2 minutes") == 120_000_000 and interval_micros("1 hour 30 minutes") == 5_400_000_000
    assert interval_micros("0.5 seconds") == 500_000 and interval_micros("1.5 hours") == 5_400_000_000
    for bad in ("", "5", "seconds", "-1 second", "1 fortnight", "0.0000005 seconds", "1 second,"):
        with pytest.raises(ValueError):
            interval_micros(bad)


def test_null_symbol_keeps_its_place_in_the_key(spark):
    from tickflow.functions.keys import row_key

    df = spark.createDataFrame([(None, "x"), ("A", "x")], "symbol string, t string")
    assert [r[0] for r in df.select(row_key("symbol", "t")).collect()] == ["None_x", "A_x"]


def test_rounded_status_vs_raw_flag(spark):
    from pyspark.sql import functions as F

    from tickflow.functions.prices import flag_anomaly

    df = spark.createDataFrame([(0.5000004,)], "price_range_pct double").withColumn(
        "r", F.round("price_range_pct", 6)
    )
    row = df.select(flag_anomaly().alias("raw"), label_status("r").alias("status")).first()
    assert row.raw is True and row.status == "NORMAL"


def test_window_stats_tumbling(spark):
    rows = [("A", 1.0, 2.0, 1), ("A", 3.0, 1.0, 29), ("A", 5.0, 1.0, 31), ("B", 2.0, 1.0, 5)]
    out = {(r.symbol, r.window_start.second): r for r in window_stats(_ticks(spark, rows)).collect()}
    a0 = out[("A", 0)]
    assert (a0.avg_price, a0.min_price, a0.max_price, a0.total_volume) == (2.0, 1.0, 3.0, 3.0)
    assert out[("A", 30)].avg_price == 5.0 and out[("B", 0)].total_volume == 1.0
    assert (a0.window_end - a0.window_start).total_seconds() == 30


def test_panes_equal_expand(spark):
    rows = [("A", float(i % 7), float(i % 3), i * 11) for i in range(200)] + [("B", None, 1.0, 40), ("B", 2.0, None, 45)]
    df = _ticks(spark, rows)
    a = moving_average(df, "2 minutes", "30 seconds", method="panes")
    b = moving_average(df, "2 minutes", "30 seconds", method="window")

    def norm(d):
        return sorted(
            (r.symbol, r.window_start, r.window_end,
             None if r.moving_avg_price is None else round(r.moving_avg_price, 9), r.total_volume)
            for r in d.collect()
        )

    assert norm(a) == norm(b)


def test_sliding_with_slide_equal_width_is_tumbling(spark):
    df = _ticks(spark, [("A", float(i), 1.0, i * 7) for i in range(50)])
    s = moving_average(df, "30 seconds", "30 seconds", method="window")
    t = window_stats(df, "30 seconds")
    assert sorted((r.window_start, r.moving_avg_price) for r in s.collect()) == sorted(
        (r.window_start, r.avg_price) for r in t.collect()
    )


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.floats(0.01, 1e6), st.integers(0, 600)), min_size=1, max_size=40))
def test_min_le_avg_le_max(spark, ticks):
    df = _ticks(spark, [("A", p, 1.0, s) for p, s in ticks])
    for r in window_stats(df, "1 minute").collect():
        assert r.min_price <= r.avg_price * (1 + 1e-12) and r.avg_price <= r.max_price * (1 + 1e-12)


def test_enrich_drops_unmatched_and_orders_columns(spark):
    stats = window_stats(_ticks(spark, [("A", 1.0, 1.0, 1), ("Z", 1.0, 1.0, 1)]), "1 hour")
    meta = spark.createDataFrame([("A", "Aname", "T", "S", "C", 2000)], METADATA)
    out = enrich(stats, meta)
    assert [r.symbol for r in out.collect()] == ["A"]
    assert out.columns[:5] == ["symbol", "full_name", "market_cap_tier", "sector", "launched_year"]
    assert "country_of_origin" not in out.columns
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_enrich_rounds_after_pct(spark):
    # pct from unrounded prices; prices rounded to 4 afterwards.
    stats = window_stats(_ticks(spark, [("A", 1.00004, 1.0, 1), ("A", 1.00006, 1.0, 2)]), "1 hour")
    meta = spark.createDataFrame([("A", "Aname", "T", "S", "C", 2000)], METADATA)
    r = enrich(stats, meta).first()
    assert r.min_price == 1.0 and r.max_price == 1.0001
    assert r.price_range_pct == round((1.00006 - 1.00004) / 1.00005 * 100, 6)


def test_panes_long_offsets(spark):
    # 1 hour by 1 minute: pane offsets reach 59 * 60e6 us (past 32-bit range).
    df = _ticks(spark, [("A", float(i), 1.0, i * 97) for i in range(100)])
    a = moving_average(df, "1 hour", "1 minute", method="panes")
    b = moving_average(df, "1 hour", "1 minute", method="window")
    assert sorted((r.window_start, round(r.moving_avg_price, 9)) for r in a.collect()) == sorted(
        (r.window_start, round(r.moving_avg_price, 9)) for r in b.collect()
    )


def _same(a, b, digits=9):
    from pyspark.sql import functions as F

    num = [c for c, d in b.dtypes if d == "double"]
    a = a.select(*b.columns).withColumns({c: F.round(c, digits) for c in num})
    b = b.withColumns({c: F.round(c, digits) for c in num})
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_pane_derivations_equal_direct_operators(spark):
    from paths import SF_SMALL
    from tickflow.operators.windows import (
        moving_average_from_panes,
        range_anomalies_from_panes,
        shared_pane,
        tick_panes,
        window_stats_from_panes,
    )
    from tickflow.plans.registry import trades

    t = trades(spark, SF_SMALL)
    pane = shared_pane("30 seconds", "1 minute", "2 minutes")
    assert pane == "30000000 microseconds"
    panes = tick_panes(t, pane, stamp=True).persist()
    try:
        assert _same(window_stats_from_panes(panes, pane, "30 seconds"), window_stats(t, "30 seconds", stamp=True))
        assert _same(window_stats_from_panes(panes, pane, "1 hour"), window_stats(t, "1 hour", stamp=True))
        assert _same(range_anomalies_from_panes(panes, pane, "1 minute"), range_anomalies(t, "1 minute", stamp=True))
        assert _same(
            moving_average_from_panes(panes, pane, "6 hours", "1 hour"),
            moving_average(t, "6 hours", "1 hour", stamp=True, method="window"),
        )
    finally:
        panes.unpersist()


def test_roll_panes_rejects_a_width_the_pane_does_not_divide(spark):
    import pytest

    from tickflow.operators.windows import roll_panes, tick_panes

    panes = tick_panes(_ticks(spark, [("A", 1.0, 1.0, 1)]), "30 seconds")
    with pytest.raises(ValueError):
        roll_panes(panes, "30 seconds", "45 seconds")


def test_panes_keep_null_prices_and_empty_groups(spark):
    from tickflow.operators.windows import range_anomalies_from_panes, tick_panes, window_stats_from_panes

    df = spark.createDataFrame(
        [("A", None, 1.0, T0), ("A", None, 2.0, T0 + dt.timedelta(seconds=40)), ("B", 4.0, None, T0)],
        "symbol string, price double, quantity double, timestamp timestamp_ntz",
    )
    panes = tick_panes(df, "30 seconds")
    got = {r.symbol: r for r in window_stats_from_panes(panes, "30 seconds", "1 minute").collect()}
    exp = {r.symbol: r for r in window_stats(df, "1 minute").collect()}
    assert got == exp
    assert got["A"].avg_price is None and got["A"].total_volume == 3.0 and got["B"].total_volume is None
    an = {r.symbol: r for r in range_anomalies_from_panes(panes, "30 seconds", "1 minute").collect()}
    assert an["A"].price_range_pct is None and an["A"].is_anomaly is False
