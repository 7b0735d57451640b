"""Watching running streams: late ticks, failing siblings, open windows.

``TickAccount`` follows one query through its progress reports and accounts for
the ticks that came too late.  ``run_together`` runs queries that belong
together and stops all when one fails.  ``open_windows`` reads the windows that
a checkpoint still holds from the state store.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickflow.functions.time import ntz_from_ltz

OBSERVED = "ticks"


def counted_input(ticks: DataFrame) -> DataFrame:
    """The stream with its rows counted by the way, as a metric of every micro-batch."""
    return ticks.observe(OBSERVED, F.count(F.lit(1)).alias("n"))


class TickAccount(StreamingQueryListener):
    """Per micro-batch of the query ``name``: ticks read, groups dropped as late, and the watermark.

    Spark drops a window's late ticks after they are aggregated, so what it counts
    are (symbol, window) groups.  The number of ticks dropped is what was read less
    what the windows hold (``window_stats(count=True)``).  Only finished batches
    are reported, so a batch that is run again counts once.
    """

    def __init__(self, name: str):
        self.name = name
        self.batches: dict[int, dict] = {}
        self._id = None
        self._ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self._id = event.id

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.name:
            return
        observed = progress.observedMetrics.get(OBSERVED)
        self.batches[progress.batchId] = {
            "ticks": observed.n if observed is not None else 0,
            "late_groups": sum(s.numRowsDroppedByWatermark for s in progress.stateOperators),
            "watermark": progress.eventTime.get("watermark"),
        }

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.id == self._id:
            self._ended.set()

    def wait(self, timeout: float = 60) -> None:
        """Reports arrive after a query's end: wait until the last one is in."""
        if not self._ended.wait(timeout):
            raise TimeoutError(f"no report of the end of {self.name}")

    def total(self, what: str) -> int:
        return sum(b[what] for b in self.batches.values())


class _StopSiblings(StreamingQueryListener):
    """Stops the other queries when one of them ends with an error."""

    def __init__(self, queries: Sequence[StreamingQuery]):
        self.queries = queries
        self.ids = {str(q.id) for q in queries}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception is not None and str(event.id) in self.ids:
            # Not on the thread that reports: a query only stops once its own reports are taken.
            threading.Thread(target=self.stop_all, daemon=True).start()

    def stop_all(self) -> None:
        for q in self.queries:
            if q.isActive:
                q.stop()


def run_together(spark: SparkSession, queries: Sequence[StreamingQuery]) -> None:
    """Wait until all queries have ended; when one fails, stop the others and raise its error.

    Each query keeps its checkpoint, so starting all of them again goes on where
    each one stopped.
    """
    listener = _StopSiblings(queries)
    spark.streams.addListener(listener)
    try:
        if any(q.exception() is not None for q in queries):  # failed before the listener was there
            listener.stop_all()
        errors = []
        for q in queries:
            try:
                q.awaitTermination()
            except Exception as e:
                errors.append(e)
        if errors:
            raise errors[0]
    finally:
        spark.streams.removeListener(listener)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows of a ``window_stats`` query that its state still holds, in the columns of its output.

    They are what a later tick can still change: the windows that end after the
    watermark.  The state is read as a table, after any finished micro-batch.
    """
    state = spark.read.format("statestore").load(checkpoint)
    # The aggregates' buffers in their order: a mean is a sum and a count.
    value = F.col("value").cast("struct<total:double,n:bigint,low:double,high:double,volume:double>")
    held = state.select(F.col("key.window").alias("window"), F.col("key.symbol").alias("symbol"), value.alias("v"))
    return held.select(
        "symbol",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.try_divide("v.total", "v.n").alias("avg_price"),
        F.col("v.low").alias("min_price"),
        F.col("v.high").alias("max_price"),
        F.col("v.volume").alias("total_volume"),
    ).withColumns({c: ntz_from_ltz(c) for c in ("window_start", "window_end")})
