"""Sources and sinks: message codec, Kafka, file replay, dimension, test data."""

from tickflow.sources.codec import (
    CORRUPT_COLUMN,
    decode_trades,
    encode_trades,
    split_bad,
    with_trade_time,
)
from tickflow.sources.files import (
    metadata_frame,
    read_file_trades,
    read_metadata,
    stage_replay,
)
from tickflow.sources.kafka import read_kafka_trades, write_kafka_trades
from tickflow.sources.testdata import (
    events_as_messages,
    events_as_trades,
    lineitem_as_ticks,
    load_table,
)

__all__ = [
    "CORRUPT_COLUMN",
    "decode_trades",
    "encode_trades",
    "events_as_messages",
    "events_as_trades",
    "lineitem_as_ticks",
    "load_table",
    "metadata_frame",
    "read_file_trades",
    "read_kafka_trades",
    "read_metadata",
    "split_bad",
    "stage_replay",
    "with_trade_time",
    "write_kafka_trades",
]
