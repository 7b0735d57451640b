"""Small incremental views for the "latest" panels of a stored table.

"Latest value per symbol" (R1, R2, R4), "seconds since the last write" (R6)
and "newest N rows" (R13) are defined over the whole stored table, so read
naively they merge its entire history on every refresh.  Instead each
micro-batch adds a few rows to two views kept next to the table:

* ``latest``: the batch's newest row per symbol.  Read: per symbol, the
  highest ``(updated_at, window_start, batch_id)`` over all batches.
* ``newest``: the batch's newest ``n`` rows of each symbol.  Read: the current
  version of each key, then the top rows asked for, of all symbols or some.

Both are exact because versions of a key are ordered by ``updated_at`` first
(``store``): a superseded version ranks below the key's current one, so it is
never chosen over it; and a current row that was not among its batch's
candidates is outranked by candidates of its symbol whose keys stay ahead of
it for good.  A read touches O(symbols x batches) rows -- O(symbols) after
``fold_views`` -- instead of the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickflow.operators.store import _glob, fold, latest_by_key, upsert

ORDER = ("updated_at", "window_start")
NEWEST_N = 100


def _newest_first(df: DataFrame) -> DataFrame:
    # The order of R13: newest write first, then symbol, then the later window.
    return df.orderBy(F.col("updated_at").desc(), F.col("symbol"), F.col("window_start").desc())


def latest_candidates(batch: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """One row per symbol: the batch's highest by ``order`` (partial max_by)."""
    values = [c for c in batch.columns if c != "symbol"]
    packed = F.struct(*[F.col(c) for c in values])
    rank = F.struct(*[F.col(c) for c in order])
    return batch.groupBy("symbol").agg(F.max_by(packed, rank).alias("_r")).select("symbol", "_r.*")


def newest_candidates(rows: DataFrame, n: int = NEWEST_N) -> DataFrame:
    """The newest ``n`` rows of each symbol (each task keeps n a symbol before the shuffle)."""
    newest = Window.partitionBy("symbol").orderBy(F.col("updated_at").desc(), F.col("window_start").desc())
    return rows.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= n).drop("_n")


def put_views(
    batch: DataFrame, root: str, batch_id: int, n: int = NEWEST_N, writer: str = "stream", epoch: str | None = None
) -> None:
    """Add one (stamped) micro-batch's candidates; the same batch again replaces them."""
    # Views are small and merged whole, so their rows are not split by day.
    whole = {"writer": writer, "epoch": epoch, "part": F.lit("all"), "files": 1}
    upsert(latest_candidates(batch), f"{root}/latest", batch_id, **whole)
    upsert(newest_candidates(batch, n), f"{root}/newest-{n}", batch_id, **whole)


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """One row per symbol: its newest row in the stored table."""
    return latest_by_key(spark, f"{root}/latest", ["symbol"], order=ORDER)


def read_newest(
    spark: SparkSession, root: str, n: int = 50, symbols: Sequence[str] | None = None
) -> DataFrame:
    """The table's newest ``n`` rows, of ``symbols`` or all; raises when the view keeps fewer."""
    kept = max((int(p.rsplit("-", 1)[1]) for p in _glob(spark, f"{root}/newest-*")), default=0)
    if n > kept:
        raise ValueError(f"the view at {root} keeps {kept} rows a symbol; read {n} from the table")
    rows = latest_by_key(spark, f"{root}/newest-{kept}", ["symbol", "window_start"])
    if symbols is not None:
        rows = rows.where(F.col("symbol").isin(list(symbols)))
    return _newest_first(rows).limit(n)


def fold_views(spark: SparkSession, root: str, keep_latest: int = 1) -> None:
    """Fold the views: one row per symbol, and the current top rows of each symbol."""
    fold(spark, f"{root}/latest", ["symbol"], keep_latest, order=ORDER)
    for path in _glob(spark, f"{root}/newest-*"):
        n = int(path.rsplit("-", 1)[1])
        fold(spark, path, ["symbol", "window_start"], keep_latest, finish=lambda df, n=n: newest_candidates(df, n))
