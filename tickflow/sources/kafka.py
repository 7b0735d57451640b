"""Kafka source and sink for trade messages.

Needs the ``spark-sql-kafka`` connector on the classpath at run time; building
the reader/writer does not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from tickflow.sources.codec import encode_trades


def kafka_source_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of the upstream subscription: one topic, latest, tolerate loss.

    At scale: ``max_offsets_per_trigger`` bounds a micro-batch (a backlog after
    a restart is then worked off in sized batches, not one huge one), and
    ``min_partitions`` splits topic partitions into more tasks so JSON parsing
    uses every core even when the topic has few partitions.
    """
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def kafka_reader(spark: SparkSession, servers: str, topic: str, **opts) -> DataStreamReader:
    return spark.readStream.format("kafka").options(**kafka_source_options(servers, topic, **opts))


def read_kafka_trades(spark: SparkSession, servers: str, topic: str, **opts) -> DataFrame:
    """Streaming frame with Kafka's columns (``value`` holds the JSON)."""
    return kafka_reader(spark, servers, topic, **opts).load()


# Producer settings of the upstream poller: wait for all replicas, retry 5 times.
KAFKA_PRODUCER_OPTIONS = {"kafka.acks": "all", "kafka.retries": "5"}


def kafka_sink_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": servers, "topic": topic}
    opts.update(KAFKA_PRODUCER_OPTIONS)
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def write_kafka_trades(
    trades: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str | None = None,
    **opts,
) -> StreamingQuery | None:
    """Encode typed trades as JSON values (no message key) and send them.

    A streaming frame starts a query (``checkpoint`` required); a batch frame is
    written once.
    """
    values = encode_trades(trades)
    options = kafka_sink_options(servers, topic, **opts)
    if trades.isStreaming:
        if not checkpoint:
            raise ValueError("a streaming Kafka sink needs a checkpoint location")
        return (
            values.writeStream.format("kafka").options(**options)
            .option("checkpointLocation", checkpoint).start()
        )
    values.write.format("kafka").options(**options).save()
    return None
