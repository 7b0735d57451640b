import datetime as dt

from tickflow.plans import reports as R

T = dt.datetime(2024, 1, 1)
W = ("symbol string, window_start timestamp_ntz, window_end timestamp_ntz, avg_price double, "
     "min_price double, max_price double, total_volume double, updated_at timestamp_ntz")
A = ("symbol string, window_start timestamp_ntz, avg_price double, max_price double, min_price double, "
     "price_range_pct double, is_anomaly boolean, updated_at timestamp_ntz")


def _w(spark, rows):
    return spark.createDataFrame(rows, W)


def _h(h):
    return T + dt.timedelta(hours=h)


def test_empty_inputs(spark):
    w, a = _w(spark, []), spark.createDataFrame([], A)
    assert R.latest_total_volume(w).first().latest_volume == 0.0
    assert R.latest_range_pct(a).first().price_range_pct == 0.0
    assert R.rows_written(w, T, _h(1)).first().rows_written == 0.0
    f = R.freshness_seconds(w, _h(1)).first()
    assert f.seconds_since_update is None and f.band is None
    c = R.anomaly_count(a, T, _h(1)).first()
    assert (c.anomalies, c.band) == (0.0, "green")


def test_latest_tie_goes_to_later_window(spark):
    w = _w(spark, [("A", T, _h(1), 1.0, 1.0, 1.0, 1.0, _h(2)), ("A", _h(1), _h(2), 2.0, 2.0, 2.0, 2.0, _h(2)),
                   ("B", T, _h(1), 5.0, 5.0, 5.0, 5.0, _h(1))])
    out = {r.symbol: r.avg_price for r in R.latest_avg_price(w).collect()}
    assert out == {"A": 2.0, "B": 5.0}
    assert R.latest_total_volume(w).first().latest_volume == 7.0


def test_symbol_filter_and_range(spark):
    w = _w(spark, [("A", T, _h(1), 1.0, 0.5, 1.5, 1.0, _h(1)), ("B", T, _h(1), 2.0, 1.0, 3.0, 1.0, _h(5))])
    assert R.rows_written(w, T, _h(2)).first().rows_written == 1.0
    assert R.rows_written(w, T, _h(5)).first().rows_written == 2.0  # inclusive end
    assert R.rows_written(w, T, _h(5), symbols=["B"]).first().rows_written == 1.0
    band = R.price_band(w, T, _h(9)).collect()
    assert [(r.metric, r.value) for r in band] == [("A max", 1.5), ("A min", 0.5), ("B max", 3.0), ("B min", 1.0)]


def test_freshness_bands(spark):
    w = _w(spark, [("A", T, _h(1), 1.0, 1.0, 1.0, 1.0, T)])
    for secs, band in [(10, "green"), (30, "yellow"), (89, "yellow"), (90, "red")]:
        r = R.freshness_seconds(w, T + dt.timedelta(seconds=secs)).first()
        assert (r.seconds_since_update, r.band) == (float(secs), band)


def test_series_legend_last_not_null(spark):
    s = spark.createDataFrame([(T, "A", 1.0), (_h(1), "A", 3.0), (_h(2), "A", None), (_h(1), "B", 2.0)],
                              "time timestamp_ntz, metric string, value double")
    out = {r.metric: (r.last_not_null, r.min, r.max) for r in R.series_legend(s).collect()}
    assert out == {"A": (3.0, 1.0, 3.0), "B": (2.0, 2.0, 2.0)}


def test_top_n_total_order(spark):
    w = _w(spark, [("A", _h(i), _h(i + 1), float(i), 0.0, 0.0, 0.0, _h(10)) for i in range(5)])
    rows = R.latest_rows(w, n=3).collect()
    assert [r.window_start for r in rows] == [_h(4), _h(3), _h(2)]


def test_summary_unweighted_mean(spark):
    w = _w(spark, [("A", T, _h(1), 1.0, 0.5, 1.5, 2.0, _h(1)), ("A", _h(1), _h(2), 2.0, 1.5, 2.5, 3.0, _h(2))])
    r = R.symbol_summary(w, T, _h(3)).first()
    assert (r.windows, r.avg_price, r.min_price, r.max_price, r.total_volume) == (2, 1.5, 0.5, 2.5, 5.0)
    assert r.last_update == _h(2)
