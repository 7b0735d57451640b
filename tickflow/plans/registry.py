"""Registered queries over the driver's tables, each with DuckDB oracle text.

Every query reads ``events`` (or ``lineitem``) in full, turns each row into a
JSON trade message and decodes it again, so decoding is always exercised and
the work grows with the table.  Means and ratios are rounded to 9 digits on
both sides: the two engines add doubles in different orders, and 9 digits
hides that without hiding any real difference.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.operators.enrich import enrich
from tickflow.operators.windows import (
    baseline_price,
    moving_average,
    range_anomalies,
    range_anomalies_from_panes,
    tick_panes,
    window_stats,
    window_stats_from_panes,
)
from tickflow.schema import METADATA
from tickflow.sources.codec import (
    CORRUPT_COLUMN,
    decode_trades,
    encode_trades,
    message_json,
    with_trade_time,
)
from tickflow.sources.testdata import events_as_messages, events_as_trades, load_table

# --- fixed values: test dimension -------------------------------------------
# Stands in for the coin dimension on the ``events`` table, whose symbols are
# event types.  ``error`` is left out and ``refund`` matches nothing, so the
# inner join is seen to drop rows on both sides.
DIMENSION_FIXTURE = [
    ("view", "Screen Views", "Tier C", "Audience", "Norway", 1998),
    ("click", "Link Clicks", "Tier B", "Interaction", "Kenya", 2003),
    ("signup", "New Accounts", "Tier B", "Growth", "Peru", 2018),
    ("refund", "Returned Orders", "Tier D", "Finance", "Japan", 2006),
    ("purchase", "Paid Orders", "Tier A", "Finance", "Chile", 1994),
]

WINDOW_FIELDS = ["symbol", "price", "quantity", "event_time"]
MEAN_DIGITS = 9


def dimension_fixture(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DIMENSION_FIXTURE, METADATA)


def trades(spark: SparkSession, sf_dir: str, fields=WINDOW_FIELDS) -> DataFrame:
    """events -> JSON messages -> decoded trades with a UTC ``timestamp_ntz``."""
    msgs = events_as_messages(load_table(spark, sf_dir, "events"))
    decoded = decode_trades(msgs, fields=fields)
    return with_trade_time(decoded, time_from="event_time", as_ntz=True)


def _round(df: DataFrame, cols, digits: int = MEAN_DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# --- Spark side ---------------------------------------------------------------


def q_decode_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = events_as_messages(load_table(spark, sf_dir, "events"))
    return with_trade_time(decode_trades(msgs), time_from="event_time", as_ntz=True)


def q_decode_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three messages per event: well formed, cut short, and a non-numeric price."""
    t = events_as_trades(load_table(spark, sf_dir, "events"))
    good = message_json(t)
    bad_price = message_json(t, overrides={"price": F.concat(F.lit("x"), F.col("price").cast("string"))})
    variants = F.array(
        F.struct(F.lit("good").alias("variant"), good.alias("text")),
        F.struct(F.lit("truncated").alias("variant"), F.left(good, F.length(good) - 1).alias("text")),
        F.struct(F.lit("bad_price").alias("variant"), bad_price.alias("text")),
    )
    texts = t.select(F.explode(variants).alias("m")).select(
        "m.variant", F.col("m.text").cast("binary").alias("value")
    )
    decoded = decode_trades(texts, keep_corrupt=True, keep=["variant"])
    return decoded.select(
        "variant",
        "trade_id",
        "symbol",
        "price",
        "quantity",
        F.col(CORRUPT_COLUMN).isNotNull().alias("is_corrupt"),
    )


def q_normalize_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer-style symbols (``CLICK-USD``) are normalised by the encoder."""
    t = events_as_trades(load_table(spark, sf_dir, "events")).withColumn(
        "symbol", F.concat(F.upper(F.col("symbol")), F.lit("-USD"))
    )
    decoded = decode_trades(encode_trades(t), fields=["trade_id", "symbol"])
    return decoded.select("trade_id", "symbol")


def q_window_stats(width: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = window_stats(trades(spark, sf_dir), width=width)
        return _round(out, ["avg_price"])

    return run


def q_moving_average(width: str, slide: str, method: str = "auto") -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = moving_average(trades(spark, sf_dir), width=width, slide=slide, method=method)
        return _round(out, ["moving_avg_price"])

    return run


def q_range_anomalies(width: str, threshold: float) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = range_anomalies(trades(spark, sf_dir, ["symbol", "price", "event_time"]), width=width, threshold=threshold)
        return _round(out, ["avg_price", "price_range_pct"])

    return run


def q_baseline_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = baseline_price(trades(spark, sf_dir, ["symbol", "price", "event_time"]), width="1 minute")
    return _round(out, ["baseline_price"])


PANE = "30 seconds"


def q_panes_window_stats(width: str) -> Callable[[SparkSession, str], DataFrame]:
    """Window stats rolled up from 30 s panes (one pass over the ticks)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = window_stats_from_panes(tick_panes(trades(spark, sf_dir), PANE), PANE, width)
        return _round(out, ["avg_price"])

    return run


def q_panes_range_anomalies(width: str, threshold: float) -> Callable[[SparkSession, str], DataFrame]:
    """Range anomalies from 30 s panes."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        panes = tick_panes(trades(spark, sf_dir, ["symbol", "price", "event_time"]), PANE)
        out = range_anomalies_from_panes(panes, PANE, width, threshold)
        return _round(out, ["avg_price", "price_range_pct"])

    return run


def q_enriched_stats_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = window_stats(trades(spark, sf_dir), width="1 hour")
    return enrich(stats, dimension_fixture(spark))


# --- DuckDB side ----------------------------------------------------------------

EPOCH = "TIMESTAMP '1970-01-01'"

# Trades as the message carries them: time truncated to whole milliseconds.
TRADES_CTE = """trades AS (
  SELECT event_type AS symbol,
         value AS price,
         CAST(json_extract(props, '$.k') AS DOUBLE) AS quantity,
         make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts
  FROM events
)"""


def _bucket(width: str, col: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{width}', {col}, {EPOCH})"


def sql_window_stats(width: str) -> str:
    return f"""WITH {TRADES_CTE}
SELECT symbol,
       {_bucket(width)} AS window_start,
       {_bucket(width)} + INTERVAL '{width}' AS window_end,
       round(avg(price), {MEAN_DIGITS}) AS avg_price,
       min(price) AS min_price,
       max(price) AS max_price,
       sum(quantity) AS total_volume
FROM trades
GROUP BY 1, 2, 3"""


def sql_moving_average(width: str, slide: str, k: int) -> str:
    return f"""WITH {TRADES_CTE},
spread AS (
  SELECT symbol, price, quantity,
         {_bucket(slide)} - i * INTERVAL '{slide}' AS window_start
  FROM trades, range({k}) AS r(i)
)
SELECT symbol, window_start,
       window_start + INTERVAL '{width}' AS window_end,
       round(avg(price), {MEAN_DIGITS}) AS moving_avg_price,
       sum(quantity) AS total_volume
FROM spread
GROUP BY 1, 2, 3"""


def _pct_sql(mx: str, mn: str, avg: str) -> str:
    return f"CASE WHEN {avg} = 0 THEN NULL ELSE ({mx} - {mn}) / {avg} * 100 END"


def sql_range_anomalies(width: str, threshold: float) -> str:
    pct = _pct_sql("max(price)", "min(price)", "avg(price)")
    return f"""WITH {TRADES_CTE}
SELECT symbol,
       {_bucket(width)} AS window_start,
       round(avg(price), {MEAN_DIGITS}) AS avg_price,
       max(price) AS max_price,
       min(price) AS min_price,
       round({pct}, {MEAN_DIGITS}) AS price_range_pct,
       coalesce({pct} > {threshold}, false) AS is_anomaly
FROM trades
GROUP BY 1, 2"""


def sql_baseline_price(width: str) -> str:
    return f"""WITH {TRADES_CTE}
SELECT symbol,
       {_bucket(width)} AS window_start,
       {_bucket(width)} + INTERVAL '{width}' AS window_end,
       round(avg(price), {MEAN_DIGITS}) AS baseline_price
FROM trades
GROUP BY 1, 2, 3"""


def dimension_values_sql() -> str:
    rows = ",\n    ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")"
        for row in DIMENSION_FIXTURE
    )
    return f"""meta(symbol, full_name, market_cap_tier, sector, country_of_origin, launched_year) AS (
  VALUES
    {rows}
)"""


def sql_enriched_stats(width: str) -> str:
    pct = f"round({_pct_sql('s.mx', 's.mn', 's.av')}, 6)"
    return f"""WITH {TRADES_CTE},
{dimension_values_sql()},
stats AS (
  SELECT symbol, {_bucket(width)} AS window_start,
         avg(price) AS av, min(price) AS mn, max(price) AS mx, sum(quantity) AS vol
  FROM trades GROUP BY 1, 2
)
SELECT s.symbol, m.full_name, m.market_cap_tier, m.sector, m.launched_year,
       s.window_start, s.window_start + INTERVAL '{width}' AS window_end,
       round(s.av, 4) AS avg_price, round(s.mn, 4) AS min_price, round(s.mx, 4) AS max_price,
       round(s.vol, 4) AS total_volume,
       {pct} AS price_range_pct,
       CASE WHEN {pct} > 0.5 THEN 'ANOMALY' ELSE 'NORMAL' END AS status
FROM stats s JOIN meta m ON s.symbol = m.symbol"""


SQL_DECODE_TRADES = """SELECT 'trade' AS event_type,
       epoch_us(ts) // 1000 AS event_time,
       event_type AS symbol,
       event_id AS trade_id,
       value AS price,
       CAST(json_extract(props, '$.k') AS DOUBLE) AS quantity,
       event_id % 2 = 0 AS buyer_maker,
       epoch_us(ts) // 1000 AS trade_time,
       make_timestamp((epoch_us(ts) // 1000) * 1000) AS "timestamp"
FROM events"""

SQL_DECODE_MALFORMED = """SELECT 'good' AS variant, event_id AS trade_id, event_type AS symbol, value AS price,
       CAST(json_extract(props, '$.k') AS DOUBLE) AS quantity, false AS is_corrupt
FROM events
UNION ALL
SELECT 'truncated', CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE),
       CAST(NULL AS DOUBLE), true
FROM events
UNION ALL
SELECT 'bad_price', event_id, event_type, CAST(NULL AS DOUBLE),
       CAST(json_extract(props, '$.k') AS DOUBLE), true
FROM events"""

SQL_NORMALIZE_SYMBOL = """SELECT event_id AS trade_id, upper(event_type) || 'USD' AS symbol FROM events"""


def registry() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    """name -> (Spark callable, DuckDB oracle text or None)."""
    from tickflow.plans.registry_reports import report_registry
    from tickflow.plans.registry_streams import stream_registry

    return {**_core_registry(), **report_registry(), **stream_registry()}


def _core_registry() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    return {
        "decode_trades": (q_decode_trades, SQL_DECODE_TRADES),
        "decode_malformed": (q_decode_malformed, SQL_DECODE_MALFORMED),
        "normalize_symbol": (q_normalize_symbol, SQL_NORMALIZE_SYMBOL),
        "window_stats_30s": (q_window_stats("30 seconds"), sql_window_stats("30 seconds")),
        "window_stats_1h": (q_window_stats("1 hour"), sql_window_stats("1 hour")),
        "moving_average_2m_30s": (
            q_moving_average("2 minutes", "30 seconds"),
            sql_moving_average("2 minutes", "30 seconds", 4),
        ),
        "moving_average_6h_1h": (
            q_moving_average("6 hours", "1 hour"),
            sql_moving_average("6 hours", "1 hour", 6),
        ),
        "moving_average_2m_30s_expand": (
            q_moving_average("2 minutes", "30 seconds", method="window"),
            sql_moving_average("2 minutes", "30 seconds", 4),
        ),
        "range_anomalies_1m": (q_range_anomalies("1 minute", 0.5), sql_range_anomalies("1 minute", 0.5)),
        "range_anomalies_1h_200": (q_range_anomalies("1 hour", 200.0), sql_range_anomalies("1 hour", 200.0)),
        "baseline_price_1m": (q_baseline_price, sql_baseline_price("1 minute")),
        "panes_window_stats_1h": (q_panes_window_stats("1 hour"), sql_window_stats("1 hour")),
        "panes_range_anomalies_1m": (q_panes_range_anomalies("1 minute", 0.5), sql_range_anomalies("1 minute", 0.5)),
        "enriched_stats_1h": (q_enriched_stats_1h, sql_enriched_stats("1 hour")),
    }
