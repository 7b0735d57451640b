"""Registered report and key-value queries over tables built from ``events``.

Stored tables are built in batch with ``updated_at`` = latest tick time of
the window (truncated to milliseconds, as the message carries it): windowed =
1 h window stats, moving_avg = 6 h by 1 h moving average, anomalies = 1 h
range anomalies at threshold 200 (so both classes occur).  ``now()`` is
``AS_OF`` and the dashboard range is the seven days before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.operators.enrich import enrich
from tickflow.operators.kv import (
    cells_of,
    explode_cells,
    merge_cells,
    to_kv_anomalies,
    to_kv_enriched,
    to_kv_moving_avg,
    to_kv_windowed,
)
from tickflow.operators.store import VERSION_COL, WRITER_COL, fold, latest_by_key, upsert
from tickflow.operators.views import fold_views, put_views, read_latest, read_newest
from tickflow.operators.windows import moving_average, range_anomalies, window_stats
from tickflow.plans import reports as R
from tickflow.plans.registry import (
    EPOCH,
    MEAN_DIGITS,
    TRADES_CTE,
    WINDOW_FIELDS,
    _bucket,
    _pct_sql,
    _round,
    dimension_fixture,
    dimension_values_sql,
    trades,
)
from tickflow.schema import ANOMALY_KEYS, MOVING_AVG_KEYS, WINDOWED_KEYS

# --- fixed report parameters ---
AS_OF = "2024-01-31 00:00:00"
RANGE_START = "2024-01-24 00:00:00"
RANGE_END = AS_OF
ANOMALY_THRESHOLD_1H = 200.0


def _ticks(spark: SparkSession, sf_dir: str, where=None, fields=WINDOW_FIELDS) -> DataFrame:
    ticks = trades(spark, sf_dir, fields)
    return ticks if where is None else ticks.where(where)


def stored_windowed(spark: SparkSession, sf_dir: str, where=None) -> DataFrame:
    return window_stats(_ticks(spark, sf_dir, where), width="1 hour", stamp=True)


def stored_moving_avg(spark: SparkSession, sf_dir: str, where=None) -> DataFrame:
    return moving_average(_ticks(spark, sf_dir, where), width="6 hours", slide="1 hour", stamp=True)


def stored_anomalies(spark: SparkSession, sf_dir: str, where=None) -> DataFrame:
    return range_anomalies(
        _ticks(spark, sf_dir, where, ["symbol", "price", "event_time"]),
        width="1 hour",
        threshold=ANOMALY_THRESHOLD_1H,
        stamp=True,
    )


def _w(spark, d):
    return stored_windowed(spark, d)


def _m(spark, d):
    return stored_moving_avg(spark, d)


def _a(spark, d):
    return stored_anomalies(spark, d)


RANGE = (RANGE_START, RANGE_END)

SPARK = {
    "latest_avg_price": lambda s, d: _round(R.latest_avg_price(_w(s, d)), ["avg_price"]),
    "latest_total_volume": lambda s, d: R.latest_total_volume(_w(s, d)),
    "anomaly_count": lambda s, d: R.anomaly_count(_a(s, d), *RANGE),
    "latest_range_pct": lambda s, d: _round(R.latest_range_pct(_a(s, d)), ["price_range_pct"]),
    "rows_written": lambda s, d: R.rows_written(_w(s, d), *RANGE),
    "freshness_seconds": lambda s, d: R.freshness_seconds(_w(s, d), AS_OF),
    "series_avg_price": lambda s, d: _round(R.series(_w(s, d), "avg_price", *RANGE), ["value"]),
    "price_band": lambda s, d: R.price_band(_w(s, d), *RANGE),
    "series_moving_avg": lambda s, d: _round(R.series(_m(s, d), "moving_avg_price", *RANGE), ["value"]),
    "series_volume": lambda s, d: R.series(_w(s, d), "total_volume", *RANGE),
    "series_range_pct": lambda s, d: _round(R.series(_a(s, d), "price_range_pct", *RANGE), ["value"]),
    "anomaly_counts_by_minute": lambda s, d: R.anomaly_counts_by_minute(_a(s, d), *RANGE),
    "latest_rows": lambda s, d: _round(R.latest_rows(_w(s, d), 50), ["avg_price"]),
    "symbol_summary": lambda s, d: R.symbol_summary(_w(s, d), *RANGE),
    "anomaly_log": lambda s, d: _round(R.anomaly_log(_a(s, d), *RANGE, n=100), ["avg_price", "price_range_pct"]),
    "symbols": lambda s, d: R.symbols(_w(s, d)),
    "series_legend": lambda s, d: _round(
        R.series_legend(R.series(_w(s, d), "avg_price", *RANGE, ordered=False)), ["last_not_null", "min", "max"]
    ),
}

# --- DuckDB text ---------------------------------------------------------------------

STORED_CTES = f"""{TRADES_CTE},
windowed AS (
  SELECT symbol, {_bucket('1 hour')} AS window_start, {_bucket('1 hour')} + INTERVAL '1 hour' AS window_end,
         avg(price) AS avg_price, min(price) AS min_price, max(price) AS max_price,
         sum(quantity) AS total_volume, max(ts) AS updated_at
  FROM trades GROUP BY 1, 2, 3
),
moving_avg AS (
  SELECT symbol, window_start, window_start + INTERVAL '6 hours' AS window_end,
         avg(price) AS moving_avg_price, sum(quantity) AS total_volume, max(ts) AS updated_at
  FROM (
    SELECT symbol, price, quantity, ts, {_bucket('1 hour')} - i * INTERVAL '1 hour' AS window_start
    FROM trades, range(6) AS r(i)
  ) GROUP BY 1, 2, 3
),
anomalies AS (
  SELECT symbol, {_bucket('1 hour')} AS window_start,
         avg(price) AS avg_price, max(price) AS max_price, min(price) AS min_price,
         {_pct_sql('max(price)', 'min(price)', 'avg(price)')} AS price_range_pct,
         coalesce({_pct_sql('max(price)', 'min(price)', 'avg(price)')} > {ANOMALY_THRESHOLD_1H}, false) AS is_anomaly,
         max(ts) AS updated_at
  FROM trades GROUP BY 1, 2
)"""

IN_RANGE = f"updated_at BETWEEN TIMESTAMP '{RANGE_START}' AND TIMESTAMP '{RANGE_END}'"
LATEST = "QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY updated_at DESC, window_start DESC) = 1"
D = MEAN_DIGITS


def _with(body: str) -> str:
    return f"WITH {STORED_CTES}\n{body}"


SQL = {
    "latest_avg_price": _with(f"SELECT symbol, round(avg_price, {D}) AS avg_price FROM windowed {LATEST}"),
    "latest_total_volume": _with(
        f"SELECT CAST(coalesce(sum(total_volume), 0) AS DOUBLE) AS latest_volume "
        f"FROM (SELECT symbol, total_volume FROM windowed {LATEST})"
    ),
    "anomaly_count": _with(
        f"SELECT CAST(count(*) AS DOUBLE) AS anomalies, "
        f"CASE WHEN count(*) >= 1 THEN 'red' ELSE 'green' END AS band "
        f"FROM anomalies WHERE {IN_RANGE} AND is_anomaly"
    ),
    "latest_range_pct": _with(
        f"SELECT round(CAST(coalesce(max(price_range_pct), 0) AS DOUBLE), {D}) AS price_range_pct "
        f"FROM (SELECT symbol, price_range_pct FROM anomalies {LATEST})"
    ),
    "rows_written": _with(f"SELECT CAST(count(*) AS DOUBLE) AS rows_written FROM windowed WHERE {IN_RANGE}"),
    "freshness_seconds": _with(
        f"""SELECT s AS seconds_since_update,
       CASE WHEN s IS NULL THEN NULL WHEN s >= 90 THEN 'red' WHEN s >= 30 THEN 'yellow' ELSE 'green' END AS band
FROM (SELECT CAST((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(updated_at))) / 1e6 AS DOUBLE) AS s FROM windowed)"""
    ),
    "series_avg_price": _with(
        f"SELECT updated_at AS time, symbol AS metric, round(avg_price, {D}) AS value FROM windowed WHERE {IN_RANGE}"
    ),
    "price_band": _with(
        f"""SELECT updated_at AS time, symbol || ' min' AS metric, min_price AS value FROM windowed WHERE {IN_RANGE}
UNION ALL
SELECT updated_at AS time, symbol || ' max' AS metric, max_price AS value FROM windowed WHERE {IN_RANGE}"""
    ),
    "series_moving_avg": _with(
        f"SELECT updated_at AS time, symbol AS metric, round(moving_avg_price, {D}) AS value "
        f"FROM moving_avg WHERE {IN_RANGE}"
    ),
    "series_volume": _with(
        f"SELECT updated_at AS time, symbol AS metric, total_volume AS value FROM windowed WHERE {IN_RANGE}"
    ),
    "series_range_pct": _with(
        f"SELECT updated_at AS time, symbol AS metric, round(price_range_pct, {D}) AS value "
        f"FROM anomalies WHERE {IN_RANGE}"
    ),
    "anomaly_counts_by_minute": _with(
        f"SELECT time_bucket(INTERVAL '1 minute', updated_at, {EPOCH}) AS time, symbol AS metric, "
        f"CAST(count(*) AS DOUBLE) AS value FROM anomalies WHERE {IN_RANGE} AND is_anomaly GROUP BY 1, 2"
    ),
    "latest_rows": _with(
        f"""SELECT updated_at AS time, symbol, round(avg_price, {D}) AS avg_price, min_price, max_price,
       total_volume, window_start, window_end
FROM windowed ORDER BY updated_at DESC, symbol, window_start DESC LIMIT 50"""
    ),
    "symbol_summary": _with(
        f"""SELECT symbol, count(*) AS windows, round(avg(avg_price), 4) AS avg_price,
       round(min(min_price), 4) AS min_price, round(max(max_price), 4) AS max_price,
       round(sum(total_volume), 4) AS total_volume, max(updated_at) AS last_update
FROM windowed WHERE {IN_RANGE} GROUP BY symbol"""
    ),
    "anomaly_log": _with(
        f"""SELECT updated_at AS time, symbol, round(price_range_pct, {D}) AS price_range_pct, is_anomaly,
       round(avg_price, {D}) AS avg_price, min_price, max_price, window_start
FROM anomalies WHERE {IN_RANGE} ORDER BY updated_at DESC, symbol, window_start DESC LIMIT 100"""
    ),
    "symbols": _with("SELECT DISTINCT symbol FROM windowed"),
    "series_legend": _with(
        f"""SELECT metric,
       round(first(value ORDER BY time DESC, value DESC) FILTER (WHERE value IS NOT NULL), {D}) AS last_not_null,
       round(min(value), {D}) AS min, round(max(value), {D}) AS max
FROM (SELECT updated_at AS time, symbol AS metric, avg_price AS value FROM windowed WHERE {IN_RANGE})
GROUP BY metric"""
    ),
}


# --- key-value queries -----------------------------------------------------------------
# Windowed puts (seq 0, 30 s windows, 6 digits) then enriched puts (seq 1) on
# the same keys; moving-average and anomaly puts go to their own tables.

KV_WIDTH = "30 seconds"


def _versions(puts: DataFrame, version: int, writer: str) -> DataFrame:
    """Puts as the store keeps them: one versioned row per cell."""
    return cells_of(puts).withColumns({VERSION_COL: F.lit(version).cast("long"), WRITER_COL: F.lit(writer)})


def kv_windowed_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = window_stats(trades(spark, sf_dir), width=KV_WIDTH)
    windowed = _versions(to_kv_windowed(stats), 0, "windowed")
    enriched = _versions(to_kv_enriched(enrich(stats, dimension_fixture(spark))), 1, "enriched")
    return merge_cells(windowed.unionByName(enriched))


def kv_moving_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    ma = moving_average(trades(spark, sf_dir), width="2 minutes", slide="30 seconds")
    return merge_cells(_versions(to_kv_moving_avg(ma), 0, "moving_avg"))


def kv_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    an = range_anomalies(trades(spark, sf_dir, ["symbol", "price", "event_time"]), width="1 minute")
    return merge_cells(_versions(to_kv_anomalies(an), 0, "anomalies"))


KV_SPARK = {
    "kv_merge_cells": lambda s, d: explode_cells(kv_windowed_merged(s, d)),
    "kv_scan_windowed": lambda s, d: R.scan_windowed(kv_windowed_merged(s, d), "error"),
    "kpi_scan": lambda s, d: R.kpi_scan(kv_windowed_merged(s, d), "click"),
    "kpi_latest": lambda s, d: R.kpi_latest(kv_windowed_merged(s, d), "click"),
    "scan_prices": lambda s, d: R.scan_prices(kv_windowed_merged(s, d), "view"),
    "scan_moving_avg": lambda s, d: R.scan_moving_avg(kv_moving_avg(s, d), "purchase"),
    "scan_anomaly_count": lambda s, d: R.scan_anomaly_count(kv_anomalies(s, d), "signup"),
}


def _key(*cols: str) -> str:
    return " || '_' || ".join(["symbol"] + [f"strftime({c}, '%Y-%m-%d %H:%M:%S')" for c in cols])


KV_CTES = f"""{TRADES_CTE},
{dimension_values_sql()},
w AS (
  SELECT symbol, {_bucket(KV_WIDTH)} AS window_start,
         avg(price) AS av, min(price) AS mn, max(price) AS mx, sum(quantity) AS vol
  FROM trades GROUP BY 1, 2
),
wcells AS (
  SELECT {_key('window_start')} AS row_key, c.cell, c.num_value, CAST(NULL AS VARCHAR) AS text_value
  FROM w, LATERAL (VALUES ('price:avg', round(av, 6)), ('price:min', round(mn, 6)),
                          ('price:max', round(mx, 6)), ('volume:total', round(vol, 6))) AS c(cell, num_value)
),
e AS (
  SELECT w.*, m.full_name, m.market_cap_tier, m.sector, m.launched_year,
         round({_pct_sql('mx', 'mn', 'av')}, 6) AS pct
  FROM w JOIN meta m ON w.symbol = m.symbol
),
ecells AS (
  SELECT {_key('window_start')} AS row_key, c.cell, c.num_value, c.text_value
  FROM e, LATERAL (VALUES
    ('price:avg', round(av, 4), NULL), ('price:min', round(mn, 4), NULL), ('price:max', round(mx, 4), NULL),
    ('price:range_pct', pct, NULL),
    ('price:status', NULL, CASE WHEN pct > 0.5 THEN 'ANOMALY' ELSE 'NORMAL' END),
    ('volume:total', round(vol, 4), NULL),
    ('price:full_name', NULL, full_name), ('price:tier', NULL, market_cap_tier),
    ('price:sector', NULL, sector), ('price:launched', CAST(launched_year AS DOUBLE), NULL)
  ) AS c(cell, num_value, text_value)
  WHERE c.num_value IS NOT NULL OR c.text_value IS NOT NULL
),
merged AS (
  SELECT * FROM ecells
  UNION ALL
  SELECT * FROM wcells x WHERE NOT EXISTS (SELECT 1 FROM ecells y WHERE y.row_key = x.row_key AND y.cell = x.cell)
),
prices AS (
  SELECT row_key,
         coalesce(max(num_value) FILTER (WHERE cell = 'price:avg'), 0.0) AS avg_price,
         coalesce(max(num_value) FILTER (WHERE cell = 'price:min'), 0.0) AS min_price,
         coalesce(max(num_value) FILTER (WHERE cell = 'price:max'), 0.0) AS max_price,
         coalesce(max(num_value) FILTER (WHERE cell = 'volume:total'), 0.0) AS total_volume
  FROM merged GROUP BY row_key
)"""


def _scan(prefix: str) -> str:
    return f"(SELECT * FROM prices WHERE starts_with(row_key, '{prefix}') ORDER BY row_key LIMIT 20)"


KV_SQL = {
    "kv_merge_cells": f"WITH {KV_CTES}\nSELECT row_key, cell, num_value, text_value FROM merged",
    "kv_scan_windowed": f"""WITH {KV_CTES}
SELECT row_key, replace(row_key, 'error_', '') AS window, avg_price, min_price, max_price, total_volume
FROM {_scan('error')}""",
    "kpi_scan": f"""WITH {KV_CTES}
SELECT replace(row_key, 'click_', '') AS window, avg_price, min_price, max_price, total_volume
FROM {_scan('click')} ORDER BY row_key DESC LIMIT 1""",
    "kpi_latest": f"""WITH {KV_CTES}
SELECT replace(row_key, 'click_', '') AS window, avg_price, min_price, max_price, total_volume
FROM prices WHERE starts_with(row_key, 'click_') ORDER BY row_key DESC LIMIT 1""",
    "scan_prices": f"""WITH {KV_CTES}
SELECT replace(row_key, 'view_', '') AS window, avg_price, min_price, max_price FROM {_scan('view')}""",
    "scan_moving_avg": f"""WITH {TRADES_CTE},
ma AS (
  SELECT symbol, window_start, window_start + INTERVAL '2 minutes' AS window_end,
         avg(price) AS av, sum(quantity) AS vol
  FROM (SELECT symbol, price, quantity, {_bucket('30 seconds')} - i * INTERVAL '30 seconds' AS window_start
        FROM trades, range(4) AS r(i))
  GROUP BY 1, 2, 3
),
scan AS (
  SELECT {_key('window_start', 'window_end')} AS row_key, round(av, 6) AS moving_avg_price, round(vol, 6) AS total_volume
  FROM ma WHERE starts_with({_key('window_start', 'window_end')}, 'purchase') ORDER BY row_key LIMIT 20
)
SELECT replace(row_key, 'purchase_', '') AS window,
       arg_min(moving_avg_price, row_key) AS moving_avg_price, arg_min(total_volume, row_key) AS total_volume
FROM scan GROUP BY 1""",
    "scan_anomaly_count": f"""WITH {TRADES_CTE},
an AS (
  SELECT symbol, {_bucket('1 minute')} AS window_start,
         coalesce({_pct_sql('max(price)', 'min(price)', 'avg(price)')} > 0.5, false) AS is_anomaly
  FROM trades GROUP BY 1, 2
),
scan AS (
  SELECT {_key('window_start')} AS row_key, is_anomaly FROM an
  WHERE starts_with({_key('window_start')}, 'signup') ORDER BY row_key LIMIT 20
)
SELECT count(*) FILTER (WHERE is_anomaly) AS anomaly_count FROM scan""",
}


# Every cell of the moving-average and anomaly tables.
KV_CELLS_SQL = {
    "moving_avg": f"""WITH {TRADES_CTE},
ma AS (
  SELECT symbol, window_start, window_start + INTERVAL '2 minutes' AS window_end, avg(price) AS av, sum(quantity) AS vol
  FROM (SELECT symbol, price, quantity, {_bucket('30 seconds')} - i * INTERVAL '30 seconds' AS window_start
        FROM trades, range(4) AS r(i))
  GROUP BY 1, 2, 3
)
SELECT {_key('window_start', 'window_end')} AS row_key, c.cell, c.num_value, CAST(NULL AS VARCHAR) AS text_value
FROM ma, LATERAL (VALUES ('price:moving_avg', round(av, 6)), ('volume:total', round(vol, 6))) AS c(cell, num_value)
WHERE c.num_value IS NOT NULL""",
    "anomalies": f"""WITH {TRADES_CTE},
an AS (
  SELECT symbol, {_bucket('1 minute')} AS window_start, avg(price) AS av, max(price) AS mx, min(price) AS mn,
         {_pct_sql('max(price)', 'min(price)', 'avg(price)')} AS pct
  FROM trades GROUP BY 1, 2
)
SELECT {_key('window_start')} AS row_key, c.cell, c.num_value, c.text_value
FROM an, LATERAL (VALUES
    ('price:avg', round(av, 6), NULL), ('price:max', round(mx, 6), NULL), ('price:min', round(mn, 6), NULL),
    ('alert:price_range_pct', round(pct, 6), NULL),
    ('alert:is_anomaly', NULL, CASE WHEN coalesce(pct > 0.5, false) THEN 'True' ELSE 'False' END)
  ) AS c(cell, num_value, text_value)
WHERE c.num_value IS NOT NULL OR c.text_value IS NOT NULL""",
}


# --- the dashboard's read path over a stored table ----------------------------------------
# The hourly stats are written as an update-mode stream leaves them: batch 0
# holds every window as of SPLIT (ticks before it), batch 1 every window that
# got a tick at or after SPLIT, complete.  Windows spanning SPLIT have two
# versions.  Panels read the table with the range's lower bound pushed below
# the merge (``latest_by_key(since=...)``), so they match the batch oracle.
SPLIT = "2024-01-27 00:30:00"


TWO_SYMBOLS = ["click", "view"]


def stored_table(spark: SparkSession, sf_dir: str, build, name: str, views: bool = False, folded: bool = False) -> str:
    from tickflow.session import scratch_path

    path = scratch_path(spark, f"stored-{name}")
    split = F.lit(SPLIT).cast("timestamp_ntz")
    batches = [
        build(spark, sf_dir, F.col("timestamp") < split),
        build(spark, sf_dir).where(F.col("updated_at") >= split),
    ]
    for batch_id, batch in enumerate(batches):
        upsert(batch, path, batch_id)
        if views:
            put_views(batch, f"{path}/views", batch_id)
    if folded:
        keys = ["symbol", "window_start", *(["window_end"] if name == "moving_avg" else [])]
        fold(spark, path, keys)
        if views:
            fold_views(spark, f"{path}/views")
    return path


def _stored_w(spark: SparkSession, sf_dir: str, folded: bool = False) -> DataFrame:
    path = stored_table(spark, sf_dir, stored_windowed, "windowed", folded=folded)
    return latest_by_key(spark, path, WINDOWED_KEYS, since=RANGE_START)


def _stored_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stored_table(spark, sf_dir, stored_moving_avg, "moving_avg")
    return latest_by_key(spark, path, MOVING_AVG_KEYS, since=RANGE_START)


def _stored_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stored_table(spark, sf_dir, stored_anomalies, "anomalies")
    return latest_by_key(spark, path, ANOMALY_KEYS, since=RANGE_START)


def _view(spark: SparkSession, sf_dir: str, build=stored_windowed, name: str = "windowed", folded: bool = False) -> str:
    return f"{stored_table(spark, sf_dir, build, name, views=True, folded=folded)}/views"


def _latest_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_latest(spark, _view(spark, sf_dir))


def _latest_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_latest(spark, _view(spark, sf_dir, stored_anomalies, "anomalies"))


def _newest(spark: SparkSession, sf_dir: str, n: int, symbols=None, folded: bool = False) -> DataFrame:
    rows = read_newest(spark, _view(spark, sf_dir, folded=folded), n, symbols)
    return _round(R.latest_rows(rows, n, symbols), ["avg_price"])


def _subset(sql: str) -> str:
    """The oracle text of a panel for ``TWO_SYMBOLS`` only."""
    names = ", ".join(f"'{s}'" for s in TWO_SYMBOLS)
    return sql.replace("FROM trades", f"FROM (SELECT * FROM trades WHERE symbol IN ({names})) AS trades")


STORED_SPARK = {
    "stored_series_avg_price": lambda s, d: _round(R.series(_stored_w(s, d), "avg_price", *RANGE), ["value"]),
    "stored_symbol_summary": lambda s, d: R.symbol_summary(_stored_w(s, d), *RANGE),
    "stored_symbol_summary_folded": lambda s, d: R.symbol_summary(_stored_w(s, d, folded=True), *RANGE),
    "stored_series_moving_avg": lambda s, d: _round(R.series(_stored_m(s, d), "moving_avg_price", *RANGE), ["value"]),
    "stored_anomaly_count": lambda s, d: R.anomaly_count(_stored_a(s, d), *RANGE),
    "stored_anomaly_log": lambda s, d: _round(
        R.anomaly_log(_stored_a(s, d), *RANGE, n=100), ["avg_price", "price_range_pct"]
    ),
    # "Latest" panels answered from the incremental views, not the history.
    "view_latest_avg_price": lambda s, d: _round(R.latest_avg_price(_latest_view(s, d)), ["avg_price"]),
    "view_latest_total_volume": lambda s, d: R.latest_total_volume(_latest_view(s, d)),
    "view_latest_range_pct": lambda s, d: _round(R.latest_range_pct(_latest_anomalies(s, d)), ["price_range_pct"]),
    "view_freshness_seconds": lambda s, d: R.freshness_seconds(_latest_view(s, d), AS_OF),
    "view_symbols": lambda s, d: R.symbols(_latest_view(s, d)),
    "view_latest_rows": lambda s, d: _newest(s, d, 50),
    "view_latest_rows_subset": lambda s, d: _newest(s, d, 50, TWO_SYMBOLS, folded=True),
    # The dashboard's symbol variable on a panel of each table.
    "subset_series_avg_price": lambda s, d: _round(
        R.series(_stored_w(s, d), "avg_price", *RANGE, symbols=TWO_SYMBOLS), ["value"]
    ),
    "subset_series_moving_avg": lambda s, d: _round(
        R.series(_stored_m(s, d), "moving_avg_price", *RANGE, symbols=TWO_SYMBOLS), ["value"]
    ),
    "subset_anomaly_log": lambda s, d: _round(
        R.anomaly_log(_stored_a(s, d), *RANGE, n=100, symbols=TWO_SYMBOLS), ["avg_price", "price_range_pct"]
    ),
}
STORED_SQL = {
    "stored_series_avg_price": SQL["series_avg_price"],
    "stored_symbol_summary": SQL["symbol_summary"],
    "stored_symbol_summary_folded": SQL["symbol_summary"],
    "stored_series_moving_avg": SQL["series_moving_avg"],
    "stored_anomaly_count": SQL["anomaly_count"],
    "stored_anomaly_log": SQL["anomaly_log"],
    "view_latest_avg_price": SQL["latest_avg_price"],
    "view_latest_total_volume": SQL["latest_total_volume"],
    "view_latest_range_pct": SQL["latest_range_pct"],
    "view_freshness_seconds": SQL["freshness_seconds"],
    "view_symbols": SQL["symbols"],
    "view_latest_rows": SQL["latest_rows"],
    "view_latest_rows_subset": _subset(SQL["latest_rows"]),
    "subset_series_avg_price": _subset(SQL["series_avg_price"]),
    "subset_series_moving_avg": _subset(SQL["series_moving_avg"]),
    "subset_anomaly_log": _subset(SQL["anomaly_log"]),
}


def report_registry() -> dict:
    out = {name: (fn, SQL[name]) for name, fn in SPARK.items()}
    out.update({name: (fn, KV_SQL[name]) for name, fn in KV_SPARK.items()})
    out.update({name: (fn, STORED_SQL[name]) for name, fn in STORED_SPARK.items()})
    return out
