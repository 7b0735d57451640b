"""Plan properties the design relies on (checked on the physical plan)."""

from paths import SF_SMALL
from tickflow.operators.enrich import enrich
from tickflow.operators.windows import moving_average, window_stats
from tickflow.plans import reports as R
from tickflow.plans.registry import dimension_fixture, trades


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_json_parsed_once_and_partial_aggregate(spark):
    p = _plan(window_stats(trades(spark, SF_SMALL), "30 seconds"))
    assert p.count("from_json(") == 1
    assert "partial_avg" in p and "partial_sum" in p
    assert "user_id" not in p  # column pruning reaches the scan


def test_panes_have_no_expand(spark):
    p = _plan(moving_average(trades(spark, SF_SMALL), "2 minutes", "30 seconds", method="panes"))
    assert "Expand" not in p and "explode" in p
    q = _plan(moving_average(trades(spark, SF_SMALL), "2 minutes", "30 seconds", method="window"))
    assert "Expand" in q


def test_dimension_broadcast_only_under_bound(spark):
    stats = window_stats(trades(spark, SF_SMALL), "1 hour")
    small = enrich(stats, dimension_fixture(spark))
    assert "BroadcastHashJoin" in _plan(small)
    # Over the bound: no hint, and the shuffle join gives the same rows.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = enrich(stats, dimension_fixture(spark), broadcast_max_rows=2)
        assert "BroadcastHashJoin" not in _plan(big)
        assert sorted(map(tuple, big.collect())) == sorted(map(tuple, small.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latest_per_symbol_is_partial(spark):
    w = window_stats(trades(spark, SF_SMALL), "1 hour", stamp=True)
    assert "partial_max_by" in _plan(R.latest_avg_price(w))
