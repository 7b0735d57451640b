"""Key-value (wide-column) view of the results, kept as parquet.

A put is a row ``(row_key, cells map<"family:qualifier", string>)``.  It is
stored as one row per cell in a keyed table (``store``) with key (row_key,
cell), so retries, several writers per table, versions and folds work as
for every other table: each cell keeps the value of its newest put, and cells
a later put did not touch survive.  Files are sorted by ``row_key`` so the
parquet statistics prune a prefix scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.functions.keys import key_time, row_key
from tickflow.operators.store import fold, latest_rows, read_log, upsert
from tickflow.schema import (
    KV_ANOMALY_CELLS,
    KV_ENRICHED_CELLS,
    KV_MOVING_AVG_CELLS,
    KV_WINDOWED_CELLS,
)

CELL_KEYS = ["row_key", "cell"]
KV_SCHEMA = T.StructType(
    [
        T.StructField("row_key", T.StringType(), True),
        T.StructField("cells", T.MapType(T.StringType(), T.StringType()), True),
    ]
)


def cell_text(c: Column, dtype: T.DataType, digits: int | None) -> Column:
    """Text of a cell value: numbers optionally rounded, booleans ``True``/``False``."""
    if isinstance(dtype, T.BooleanType):
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    if isinstance(dtype, (T.DoubleType, T.FloatType)) and digits is not None:
        return F.round(c, digits).cast("string")
    return c.cast("string")


def to_kv(
    df: DataFrame,
    key_cols: Sequence[Column],
    cells: Mapping[str, str],
    digits: int | None = None,
) -> DataFrame:
    """Rows -> ``(row_key, cells)``; null values make no cell."""
    types = {f.name: f.dataType for f in df.schema.fields}
    entries = []
    for cell, col in cells.items():
        entries += [F.lit(cell), cell_text(F.col(col), types[col], digits)]
    cell_map = F.map_filter(F.create_map(*entries), lambda k, v: v.isNotNull())
    return df.select(row_key(*key_cols).alias("row_key"), cell_map.alias("cells"))


def to_kv_windowed(df: DataFrame, digits: int | None = 6) -> DataFrame:
    return to_kv(df, [F.col("symbol"), key_time("window_start")], KV_WINDOWED_CELLS, digits)


def to_kv_moving_avg(df: DataFrame, digits: int | None = 6) -> DataFrame:
    return to_kv(
        df, [F.col("symbol"), key_time("window_start"), key_time("window_end")], KV_MOVING_AVG_CELLS, digits
    )


def to_kv_anomalies(df: DataFrame, digits: int | None = 6) -> DataFrame:
    return to_kv(df, [F.col("symbol"), key_time("window_start")], KV_ANOMALY_CELLS, digits)


def to_kv_enriched(df: DataFrame) -> DataFrame:
    """Enriched rows are already rounded (4 / 6 digits); values go in as they are."""
    return to_kv(df, [F.col("symbol"), key_time("window_start")], KV_ENRICHED_CELLS, None)


def cells_of(kv: DataFrame) -> DataFrame:
    """``(row_key, cell, value)`` rows; a null value is no cell."""
    return kv.select("row_key", F.explode("cells").alias("cell", "value")).where(F.col("value").isNotNull())


def put_kv(
    kv: DataFrame, path: str, seq: int, writer: str = "put", epoch: str | None = None, files: int | None = None
) -> None:
    """Write batch ``seq`` of puts from ``writer``; the same batch again replaces it.  ``files``: see ``upsert``."""
    day = F.regexp_extract("row_key", r"_(\d{4}-\d{2}-\d{2}) ", 1)
    upsert(cells_of(kv), path, seq, sort_by=CELL_KEYS, writer=writer, epoch=epoch, part=day, files=files)


def rows_of(cells: DataFrame) -> DataFrame:
    """Merged cells back to one map per row (bounded by the number of cell names)."""
    return cells.groupBy("row_key").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("cell", "value")))).alias("cells")
    )


def merge_cells(versions: DataFrame) -> DataFrame:
    """Cell-level last-write-wins over stored cell versions (the read side's merge).

    ``versions``: row_key, cell, value, version, writer.  One shuffle on
    ``row_key`` serves both aggregates: rows of a (row_key, cell) and cells of
    a row_key meet in the same task.  A row has a few cells of a few versions.
    """
    return rows_of(latest_rows(versions.repartition("row_key"), CELL_KEYS))


def read_kv(
    spark: SparkSession, path: str, prefix: str | None = None, limit: int | None = None, exact: bool = False
) -> DataFrame:
    """The merged key-value table at ``path`` (newest put per cell wins).

    With ``prefix`` only row keys that start with it are read, and with
    ``limit`` only the first ``limit`` of them: the keys are picked before
    anything is merged.
    """
    versions = read_log(spark, path)
    if versions is None:
        return spark.createDataFrame([], KV_SCHEMA)
    if prefix is not None:
        versions = versions.where(F.col("row_key").startswith(prefix + "_" if exact else prefix))
    if limit is not None:
        first = versions.select("row_key").distinct().orderBy("row_key").limit(limit)
        versions = versions.join(F.broadcast(first), "row_key", "left_semi")  # at most ``limit`` keys
    return merge_cells(versions)


def fold_kv(spark: SparkSession, path: str, keep_latest: int = 1) -> int:
    """Fold the puts into the days of their row keys (see ``store.fold``)."""
    return fold(spark, path, CELL_KEYS, keep_latest)


def scan_prefix(kv: DataFrame, prefix: str, limit: int | None = 20, exact: bool = False) -> DataFrame:
    """Key-ascending scan of rows whose key starts with ``prefix``.

    As upstream, the bare symbol is the prefix, so ``AB`` also matches
    ``ABC_...``; ``exact=True`` appends the ``_`` separator.  The predicate is
    on ``row_key`` only, so it is pushed below the merge to the parquet scan.
    """
    p = prefix + "_" if exact else prefix
    rows = kv.where(F.col("row_key").startswith(p)).orderBy("row_key")
    return rows.limit(limit) if limit is not None else rows


def _cell(name: str) -> Column:
    return F.try_element_at(F.col("cells"), F.lit(name))


def _num(name: str) -> Column:
    return F.coalesce(_cell(name).try_cast("double"), F.lit(0.0))


def _label(symbol: str) -> Column:
    return F.replace(F.col("row_key"), F.lit(symbol + "_"), F.lit(""))


def decode_kv_windowed(scan: DataFrame, symbol: str) -> DataFrame:
    """Scan rows -> window label and prices as doubles (missing -> 0.0)."""
    return scan.select(
        "row_key",
        _label(symbol).alias("window"),
        _num("price:avg").alias("avg_price"),
        _num("price:min").alias("min_price"),
        _num("price:max").alias("max_price"),
        _num("volume:total").alias("total_volume"),
    )


def decode_kv_moving_avg(scan: DataFrame, symbol: str) -> DataFrame:
    return scan.select(
        "row_key",
        _label(symbol).alias("window"),
        _num("price:moving_avg").alias("moving_avg_price"),
        _num("volume:total").alias("total_volume"),
    )


def decode_kv_anomalies(scan: DataFrame, symbol: str) -> DataFrame:
    return scan.select(
        "row_key",
        _label(symbol).alias("window"),
        _num("price:avg").alias("avg_price"),
        _num("price:max").alias("max_price"),
        _num("price:min").alias("min_price"),
        _num("alert:price_range_pct").alias("price_range_pct"),
        F.coalesce(_cell("alert:is_anomaly"), F.lit("False")).alias("is_anomaly"),
    )


def explode_cells(kv: DataFrame) -> DataFrame:
    """``(row_key, cell, value)`` rows, numbers also parsed to double."""
    return kv.select("row_key", F.explode("cells").alias("cell", "value")).select(
        "row_key",
        "cell",
        F.col("value").try_cast("double").alias("num_value"),
        F.when(F.col("value").try_cast("double").isNull(), F.col("value")).alias("text_value"),
    )
