"""File sources: the replay stand-in for Kafka and the static dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.schema import METADATA
from tickflow.sources.codec import CORRUPT_COLUMN

# Same contract as the Kafka source: the message is in a binary ``value``.
REPLAY_SCHEMA = T.StructType([T.StructField("value", T.BinaryType(), True)])


def stage_replay(messages: DataFrame, path: str, n_files: int, order_col: str) -> list[str]:
    """Write messages as ``n_files`` time-ordered parquet files for replay.

    One distributed job range-partitions on ``order_col``; the file of range i
    then gets modification time base + i seconds, because the file stream
    source hands files out in modification-time order.  Returns the files in
    replay order.
    """
    spark = messages.sparkSession
    (
        messages.repartitionByRange(n_files, order_col)
        .sortWithinPartitions(order_col)
        .select("value")
        .write.mode("error")
        .parquet(path)
    )
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(
        (st.getPath() for st in fs.listStatus(hpath) if st.getPath().getName().startswith("part-")),
        key=lambda p: p.getName(),
    )
    base = jvm.java.lang.System.currentTimeMillis() - 1000 * (len(parts) + 1)
    for i, p in enumerate(parts):
        fs.setTimes(p, base + 1000 * i, -1)
    return [p.toString() for p in parts]


def read_file_trades(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int = 1,
    fmt: str = "parquet",
) -> DataFrame:
    """Streaming frame over replay files, oldest file first.

    ``fmt="parquet"`` reads staged files with a binary ``value``; ``fmt="text"``
    reads one JSON message per line (``value`` cast to binary, the Kafka
    contract).
    """
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "text":
        return reader.text(path).select(F.col("value").cast("binary").alias("value"))
    return reader.schema(REPLAY_SCHEMA).format(fmt).load(path)


def read_metadata(
    spark: SparkSession, path: str, schema: T.StructType = METADATA, keep_corrupt: bool = False
) -> DataFrame:
    """The static dimension CSV (header row), with an explicit schema.

    The upstream job inferred the schema; a fixed one avoids the extra pass and
    makes ``launched_year`` an int whatever the file holds.  The header must name
    the schema's columns in their order, else reading raises.  A row whose value
    has another type, or that has too few or too many, raises too; with
    ``keep_corrupt`` it is kept, its bad values null and its text in ``_corrupt_record``.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if keep_corrupt:
        corrupt = T.StructField(CORRUPT_COLUMN, T.StringType(), True)
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        return reader.schema(T.StructType(schema.fields + [corrupt])).csv(path)
    return reader.option("mode", "FAILFAST").schema(schema).csv(path)


def metadata_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType = METADATA) -> DataFrame:
    """The dimension from in-memory rows."""
    return spark.createDataFrame(list(rows), schema)


def write_metadata(meta: DataFrame, path: str) -> None:
    meta.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
