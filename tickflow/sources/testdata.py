"""Adapters from the driver's parquet tables to trade messages and ticks.

``events`` stands in for the tick stream: event_type -> symbol, value -> price,
props.k -> quantity, ts -> epoch-ms event/trade time, even event_id -> buyer
maker.  Every query goes through the JSON encode/decode, like the real stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.functions.time import epoch_ms_of_ntz
from tickflow.sources.codec import encode_trades


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_as_trades(events: DataFrame) -> DataFrame:
    """Typed trade columns from ``events`` (one trade per event)."""
    ms = epoch_ms_of_ntz("ts")
    return events.select(
        F.lit("trade").alias("event_type"),
        ms.alias("event_time"),
        F.col("event_type").alias("symbol"),
        F.col("event_id").alias("trade_id"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").try_cast("double").alias("quantity"),
        ((F.col("event_id") % 2) == 0).alias("buyer_maker"),
        ms.alias("trade_time"),
    )


def events_as_messages(events: DataFrame, keep_ts: bool = False) -> DataFrame:
    """Binary JSON ``value`` per event (plus ``ts`` when asked, for ordering)."""
    trades = events_as_trades(events)
    if not keep_ts:
        return encode_trades(trades)
    return encode_trades(trades.withColumn("ts", F.col("event_time")), keep=["ts"])


def lineitem_as_ticks(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as typed ticks (benchmarks): flag+status is the symbol."""
    return lineitem.select(
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("symbol"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_shipdate").alias("timestamp"),
    )
