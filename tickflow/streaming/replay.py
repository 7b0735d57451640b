"""Replay the ``events`` table as a time-ordered stream of JSON messages.

Stands in for the Kafka topic: the messages are staged as N files under the
shared work folder and read back with ``maxFilesPerTrigger=1`` and an
``availableNow`` trigger, so every file is one micro-batch, in time order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.session import scratch_path
from tickflow.sources.codec import decode_trades, with_trade_time
from tickflow.sources.files import read_file_trades, stage_replay
from tickflow.sources.testdata import events_as_messages, load_table

AVAILABLE_NOW = {"availableNow": True}


# Input per replay file: the staging job sorts and writes one file per task, so
# a file holds at most about this many bytes of input on disk and this many
# messages, whatever the batch count.  The messages are what a task sorts: a
# compressed tick takes some 16 bytes on disk and 250 in the sort.
REPLAY_FILE_BYTES = 128 << 20
REPLAY_FILE_ROWS = 250_000


def files_per_batch(spark: SparkSession, df: DataFrame, n_batches: int, file_bytes: int = REPLAY_FILE_BYTES) -> int:
    """Replay files per micro-batch, from the input files' size on disk and the rows of ``df``."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    total = 0
    for f in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(f)
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
    rows = df.agg(F.count(F.lit(1))).first()[0]  # reads no column
    return max(1, -(-total // (n_batches * file_bytes)), -(-rows // (n_batches * REPLAY_FILE_ROWS)))


def stage_messages(
    spark: SparkSession,
    messages: DataFrame,
    path: str,
    n_batches: int,
    order_col: str,
    file_bytes: int = REPLAY_FILE_BYTES,
) -> DataFrame:
    """Stage messages in ``n_batches`` micro-batches ordered by ``order_col``; return
    the raw ``value`` stream.

    Each micro-batch is several range files when the input is large (one
    staging task per file), replayed ``maxFilesPerTrigger`` at a time: the
    files' modification times rise with their range, so any run of
    consecutive files is an ordered slice.  Small inputs give one file
    per batch.
    """
    per_batch = files_per_batch(spark, messages, n_batches, file_bytes)
    stage_replay(messages, path, n_batches * per_batch, order_col)
    return read_file_trades(spark, path, max_files_per_trigger=per_batch)


def stage_events(
    spark: SparkSession,
    sf_dir: str,
    n_files: int = 5,
    root: str | None = None,
    file_bytes: int = REPLAY_FILE_BYTES,
) -> tuple[DataFrame, str]:
    """Stage events as messages in ``n_files`` time-ordered micro-batches (see
    ``stage_messages``); return the raw ``value`` stream and its root."""
    root = root or scratch_path(spark, "replay")
    msgs = events_as_messages(load_table(spark, sf_dir, "events"), keep_ts=True)
    return stage_messages(spark, msgs, f"{root}/in", n_files, "ts", file_bytes), root


def replay_events(
    spark: SparkSession,
    sf_dir: str,
    n_files: int = 5,
    fields: Sequence[str] | None = None,
    root: str | None = None,
    file_bytes: int = REPLAY_FILE_BYTES,
) -> tuple[DataFrame, str]:
    """Stage events as messages; return the decoded trade stream and its root."""
    stream, root = stage_events(spark, sf_dir, n_files, root, file_bytes)
    decoded = decode_trades(stream, fields=fields)
    return with_trade_time(decoded, time_from="event_time"), root


def run_until_done(*queries) -> None:
    """Wait for ``availableNow`` queries to drain; raise the first failure."""
    for q in queries:
        q.awaitTermination()
        err = q.exception()
        if err is not None:
            raise RuntimeError(f"streaming query {q.name} failed: {err}")
