"""Keyed, idempotent result tables: plain Parquet datasets by day, merged on read.

A write is one batch of a writer, an ordinary Parquet dataset partitioned by day::

    path/log/w_=<writer>/e_=<epoch>/b_=<batch>/v_=<version>/day_=<day>/part-*.parquet
    path/base/slot_=<0 or 1>/day_=<day>/part-*.parquet
    path/folded/<folder>                                  empty: readers skip that folder

Every row carries the ``version`` of its write (microseconds) and its writer, and
a read is one aggregate: of all stored rows of a key the one with the highest
``updated_at`` (where the table has it), version and writer is current.  Rows that
are stored twice do not change that, which is what keeps all else simple:

* Writing (writer, epoch, batch) again adds the new rows, then deletes the older
  ones, so a retried micro-batch leaves the table unchanged.  ``epoch`` tells
  streams with different checkpoints apart; a backfill is a writer of its own.
* ``fold`` merges finished batches into whole days, written by Spark's dynamic
  partition overwrite to the slot that a day does not use.  What that replaces is
  only marked, so that later readers skip it, and deleted by the next fold.  A
  reader that began before a fold still finds its files, and one beside it finds
  every row at least once.

Readers leave the listing of files to Spark and list the marks of the last fold.  A batch whose write is just being
committed may be seen in part; rows of one key are never split.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterable, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION_COL = "version"
WRITER_COL = "writer"
TIME_COL = "updated_at"
DAY = "day_"
SLOT = "slot_"
FOLDERS = {"base": [SLOT, DAY], "log": ["w_", "e_", "b_", "v_"]}  # what a mark names in either dataset

_EPOCH: ContextVar[str] = ContextVar("epoch", default="0")


@contextmanager
def writing_epoch(epoch: str):
    """Writes inside belong to ``epoch`` (the id of a stream's checkpoint)."""
    token = _EPOCH.set(epoch)
    try:
        yield
    finally:
        _EPOCH.reset(token)


# --- Hadoop file-system helpers (metadata calls on the driver only) ---------


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, hpath = _fs(spark, pattern)
    return [st.getPath().toString() for st in (fs.globStatus(hpath) or [])]


def _exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return bool(fs.exists(hpath))


def _delete(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)


def _read_text(spark: SparkSession, path: str) -> str:
    fs, hpath = _fs(spark, path)
    stream = fs.open(hpath)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


# --- write side ------------------------------------------------------------------


_last_version = 0
_version_lock = threading.Lock()


def _next_version() -> int:
    global _last_version
    with _version_lock:
        _last_version = max(time.time_ns() // 1000, _last_version + 1)
        return _last_version


def _day(df: DataFrame, part: Column | None) -> Column:
    """The day of a row, of ``window_start`` by default, as a plain folder name."""
    if part is None:
        part = F.to_date("window_start") if "window_start" in df.columns else F.lit("all")
    return F.concat(F.lit("d"), F.regexp_replace(F.coalesce(part.cast("string"), F.lit("")), "[^A-Za-z0-9-]", "_"))


def upsert(
    df: DataFrame,
    path: str,
    batch_id: int,
    sort_by: Sequence[str] = (),
    writer: str = "stream",
    epoch: str | None = None,
    part: Column | None = None,
    files: int | None = None,
) -> None:
    """Write one batch of ``writer``; writing the same batch again replaces it.

    Keys must be unique within one batch (update mode emits each group once per
    batch) and determine the row's day, ``part``.  ``sort_by`` orders rows inside
    each file so parquet statistics prune key-range reads.  Rows are dealt out by
    ranges of day and key, to ``files`` tasks if given, so each task writes few days.
    """
    spark = df.sparkSession
    version = _next_version()
    out = df.withColumns({VERSION_COL: F.lit(version).cast("long"), WRITER_COL: F.lit(writer), DAY: _day(df, part)})
    ranges = ([files] if files else []) + [DAY, *sort_by]
    out = out.repartitionByRange(*ranges).sortWithinPartitions(DAY, *sort_by)
    batch = f"{path}/log/w_={writer}/e_={epoch or _EPOCH.get()}/b_={int(batch_id)}"
    out.write.partitionBy(DAY).parquet(f"{batch}/v_={version}")
    for older in _glob(spark, f"{batch}/v_=*"):
        if int(older.rsplit("=", 1)[1]) < version:
            _delete(spark, older)


# --- read side -------------------------------------------------------------------


def _marks(spark: SparkSession, path: str) -> list[list[str]]:
    """What the last fold replaced: the dataset (base or log) and the values of its folder columns."""
    return [m.rsplit("/", 1)[1].split(",") for m in _glob(spark, f"{path}/folded/*")]


def _folder(path: str, mark: list[str]) -> str:
    return "/".join([path, mark[0], *(f"{c}={v}" for c, v in zip(FOLDERS[mark[0]], mark[1:]))])


def _rows(
    spark: SparkSession, root: str, paths: list[str], schema: T.StructType | None = None, skip: Sequence[str] = ()
) -> DataFrame | None:
    """Stored rows below ``paths`` of the dataset ``root`` with their day; None where nothing is stored.

    ``skip``: folders left out, as values of the folder columns joined by ``/``; a filter on partitions.
    """
    reader = spark.read.option("basePath", root)
    if schema is not None:
        stored = [T.StructField(VERSION_COL, T.LongType()), T.StructField(WRITER_COL, T.StringType())]
        reader = reader.schema(T.StructType(schema.fields + stored))
    try:
        found = reader.parquet(*paths)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    folders = FOLDERS[root.rsplit("/", 1)[1]]
    if skip and set(folders) <= set(found.columns):
        found = found.where(~F.concat_ws("/", *[F.col(c).cast("string") for c in folders]).isin(list(skip)))
    return found.drop(SLOT, *FOLDERS["log"])


def read_log(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Every stored row version (folded rows and batches), with ``version`` and ``writer``."""
    marks = _marks(spark, path)
    found = [
        _rows(spark, f"{path}/{name}", [f"{path}/{name}"], schema, ["/".join(m[1:]) for m in marks if m[0] == name])
        for name in FOLDERS
        if _exists(spark, f"{path}/{name}")
    ]
    found = [rows.drop(DAY) for rows in found if rows is not None]
    if not found and schema is not None:
        stored = [T.StructField(VERSION_COL, T.LongType()), T.StructField(WRITER_COL, T.StringType())]
        return spark.createDataFrame([], T.StructType(schema.fields + stored))
    return reduce(DataFrame.unionByName, found) if found else None


def _rank(df: DataFrame, order: Sequence[str]) -> Column:
    first = list(order) or ([TIME_COL] if TIME_COL in df.columns else [])
    return F.struct(*[F.col(c) for c in (*first, VERSION_COL, WRITER_COL)])


def latest_rows(
    log: DataFrame,
    keys: Sequence[str],
    keep_version: bool = False,
    order: Sequence[str] = (),
) -> DataFrame:
    """Per key, the row with the highest ``(*order, version, writer)`` (partial
    ``max_by``, no window); ``order`` is ``updated_at`` where the rows have it."""
    values = [c for c in log.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in values])
    out = log.groupBy(*keys).agg(F.max_by(packed, _rank(log, order)).alias("_row")).select(*keys, "_row.*")
    return out if keep_version else out.drop(VERSION_COL, WRITER_COL)


def since_filter(df: DataFrame, since, time_col: str = TIME_COL) -> DataFrame:
    """Rows with ``time_col >= since``; a text or datetime bound is cast to
    the column's type (``timestamp_ntz`` in the stored tables)."""
    if since is None:
        return df
    bound = since if isinstance(since, Column) else F.lit(since).cast(df.schema[time_col].dataType)
    return df.where(F.col(time_col) >= bound)


def latest_by_key(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    schema: T.StructType | None = None,
    keep_version: bool = False,
    since=None,
    order: Sequence[str] = (),
) -> DataFrame:
    """The current table: the current version of every key (``order``: see ``latest_rows``).

    ``since`` returns only the keys whose current version has ``updated_at >=
    since``, and drops older versions *before* the merge.  That is exact
    because versions are ordered by ``updated_at`` first.  The predicate
    reaches the parquet scans, so a panel over the last 30 minutes skips
    the row groups of older batches and days instead of merging all history.
    """
    log = read_log(spark, path, schema)
    if log is None:
        raise FileNotFoundError(f"no stored table at {path}")
    return latest_rows(since_filter(log, since), keys, keep_version, order)


# --- fold ------------------------------------------------------------------------


def _name(folder: str) -> str:
    return folder.rsplit("=", 1)[1]


def fold(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    keep_latest: int = 1,
    order: Sequence[str] = (),
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Merge finished batches into the days they touch; other days keep their files.

    Each (writer, epoch) keeps its newest ``keep_latest`` batches out: Structured
    Streaming may re-run its last batch after a restart.  ``finish`` may trim the
    folded rows (a view keeping its top n).  One fold per table may run at a
    time, beside any number of readers and writers.  Returns the number of
    batches folded.

    A fold that dies is simply repeated: batches are marked only after the days
    that hold their rows are written and the copies these replace are marked.
    """
    for mark in _marks(spark, path):
        _delete(spark, _folder(path, mark))
        _delete(spark, f"{path}/folded/{','.join(mark)}")
    streams: dict[str, list[str]] = {}
    for batch in _glob(spark, f"{path}/log/*/*/b_=*"):
        if _glob(spark, f"{batch}/v_=*"):
            streams.setdefault(batch.rsplit("/", 1)[0], []).append(batch)
    done = []
    for batches in streams.values():
        batches.sort(key=lambda b: int(_name(b)))
        done += batches[: max(0, len(batches) - keep_latest)]
    days = {_name(d) for batch in done for d in _glob(spark, f"{batch}/*/{DAY}=*")}
    if not days:
        return 0
    writes = [w for batch in done for w in _glob(spark, f"{batch}/v_=*")]
    held = {slot: {_name(d): d for d in _glob(spark, f"{path}/base/{SLOT}={slot}/{DAY}=*") if _name(d) in days} for slot in (0, 1)}
    rows = _rows(spark, f"{path}/log", writes)
    replaced = [*held[0].values(), *held[1].values()]
    if replaced:
        rows = rows.unionByName(_rows(spark, f"{path}/base", replaced))
    # The day is determined by the key, so it is carried as one of the values.
    folded = latest_rows(rows, keys, True, order)
    if finish:
        folded = finish(folded)
    used = F.col(DAY).isin(list(held[0])) if held[0] else F.lit(False)  # days, not rows
    (
        folded.withColumn(SLOT, F.when(used, 1).otherwise(0))
        .repartitionByRange(DAY, *keys)
        .sortWithinPartitions(SLOT, DAY, *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SLOT, DAY)
        .parquet(f"{path}/base")
    )
    older = [["base", "0", day] for day in held[0]] + [["base", "1", day] for day in held[1] if day not in held[0]]
    for mark in older + [["log", *(_name(f) for f in w.split("/")[-4:])] for w in writes]:
        fs, hpath = _fs(spark, f"{path}/folded/{','.join(mark)}")
        fs.create(hpath, True).close()
    return len(done)


# --- external SQL upsert -------------------------------------------------------------


def upsert_sql(
    table: str,
    columns: Sequence[str],
    keys: Sequence[str],
    placeholder: str = "?",
    touch: str | None = "updated_at",
    now_sql: str = "CURRENT_TIMESTAMP",
) -> str:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE`` (PostgreSQL / SQLite syntax)."""
    cols = ", ".join(columns)
    marks = ", ".join([placeholder] * len(columns))
    sets = [f"{c} = excluded.{c}" for c in columns if c not in keys]
    if touch:
        sets.append(f"{touch} = {now_sql}")
    return (
        f"INSERT INTO {table} ({cols}) VALUES ({marks}) "
        f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {', '.join(sets)}"
    )


def upsert_dbapi(
    df: DataFrame,
    connect: Callable[[], object],
    table: str,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    placeholder: str = "?",
    touch: str | None = "updated_at",
    now_sql: str = "CURRENT_TIMESTAMP",
    batch_size: int = 1000,
    convert: Callable[[object], object] | None = None,
    max_connections: int = 8,
    send: Callable[[object, str, list], None] | None = None,
) -> None:
    """Upsert rows into an external SQL table from the executors.

    At most ``max_connections`` tasks write, each over its own connection from
    ``connect`` (a picklable factory).  A batch goes out by ``send(cursor, sql,
    rows)``, by default ``executemany``; pass the driver's multi-row insert
    where ``executemany`` sends row by row.  Each task commits once; errors propagate
    so Spark retries the task and the streaming batch is not marked done.  The
    statement is an idempotent upsert, so a retry is harmless.  Nothing passes
    through the driver.
    """
    cols = list(columns or df.columns)
    send = send or (lambda cursor, statement, rows: cursor.executemany(statement, rows))
    sql = upsert_sql(table, cols, keys, placeholder, touch, now_sql)

    def write_partition(rows: Iterable) -> None:
        conn = None
        try:
            buf = []
            for row in rows:
                if conn is None:
                    conn = connect()
                    cur = conn.cursor()
                vals = tuple(row[c] for c in cols)
                if convert is not None:
                    vals = tuple(convert(v) for v in vals)
                buf.append(vals)
                if len(buf) >= batch_size:
                    send(cur, sql, buf)
                    buf = []
            if buf:
                send(cur, sql, buf)
            if conn is not None:
                conn.commit()
        finally:
            if conn is not None:
                conn.close()

    df.select(*cols).coalesce(max_connections).foreachPartition(write_partition)
