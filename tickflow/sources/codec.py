"""Trade messages: JSON decode/encode, stream time, malformed-row routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.functions.keys import normalize_symbol
from tickflow.functions.time import ntz_from_epoch_ms, ntz_from_ltz
from tickflow.schema import TRADE

CORRUPT_COLUMN = "_corrupt_record"


def narrow_schema(schema: T.StructType, fields: Sequence[str] | None) -> T.StructType:
    """Keep only ``fields`` (in schema order).

    ``from_json`` materialises every field of its schema and Catalyst does not
    prune it afterwards, so callers that need three of eight fields say so.
    """
    if not fields:
        return schema
    wanted = set(fields)
    missing = wanted - set(schema.fieldNames())
    if missing:
        raise ValueError(f"unknown trade fields: {sorted(missing)}")
    return T.StructType([f for f in schema.fields if f.name in wanted])


def decode_trades(
    df: DataFrame,
    schema: T.StructType = TRADE,
    fields: Sequence[str] | None = None,
    keep_corrupt: bool = False,
    value_col: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """binary/string ``value`` -> one typed column per message field.

    PERMISSIVE parsing: text that is not JSON gives an all-null row, a field of
    the wrong type gives a null field, unknown fields are ignored.  With
    ``keep_corrupt`` the raw text of any message that did not parse cleanly is
    kept in ``_corrupt_record``.  ``keep`` carries other input columns along.

    The parsed struct is expanded with ``inline(array(...))`` rather than
    ``select("m.*")``: a generator is a barrier for predicate pushdown, so a
    later filter on a message field (``F.window`` adds ``isnotnull(time)``)
    is not inlined below it as a second ``from_json`` call -- every message is
    parsed exactly once (about 40% less time on the window queries).
    """
    sch = narrow_schema(schema, fields)
    options = {"mode": "PERMISSIVE"}
    if keep_corrupt:
        sch = T.StructType(sch.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
        options["columnNameOfCorruptRecord"] = CORRUPT_COLUMN
    parsed = F.from_json(F.col(value_col).cast("string"), sch, options)
    return df.select(F.inline(F.array(parsed)), *keep)


def split_bad(decoded: DataFrame, required: Sequence[str] = ("symbol", "price")) -> tuple[DataFrame, DataFrame]:
    """Route rows that failed to parse, or miss a required field, away.

    Returns ``(good, bad)``; ``good`` no longer has ``_corrupt_record``.  Needs a
    frame decoded with ``keep_corrupt=True``.
    """
    bad_cond = F.col(CORRUPT_COLUMN).isNotNull()
    for name in required:
        bad_cond = bad_cond | F.col(name).isNull()
    good = decoded.where(~bad_cond).drop(CORRUPT_COLUMN)
    bad = decoded.where(bad_cond)
    return good, bad


def with_trade_time(
    df: DataFrame,
    time_from: str = "processing",
    as_ntz: bool = False,
    out: str = "timestamp",
) -> DataFrame:
    """Add the column the windows run on.

    ``processing`` stamps ``current_timestamp()`` (one value per query or
    micro-batch, as the upstream jobs do); ``event_time`` / ``trade_time`` use
    the message's epoch-millisecond field, which makes a run replayable.
    ``as_ntz`` gives the UTC wall clock as ``timestamp_ntz`` (batch queries);
    streaming watermarks need the default ``timestamp``.
    """
    if time_from == "processing":
        ts = F.current_timestamp()
        col = ntz_from_ltz(ts) if as_ntz else ts
    elif time_from in ("event_time", "trade_time"):
        col = ntz_from_epoch_ms(time_from) if as_ntz else F.timestamp_millis(F.col(time_from))
    else:
        raise ValueError(f"time_from must be processing, event_time or trade_time, not {time_from!r}")
    return df.withColumn(out, col)


def message_json(
    df: DataFrame,
    schema: T.StructType = TRADE,
    quantity_digits: int | None = 6,
    overrides: dict | None = None,
):
    """JSON text column of the message fields present in ``df``.

    Symbols are normalised (``BTC-USD`` -> ``BTCUSD``) and quantity rounded to
    ``quantity_digits``, like the producer.  ``overrides`` replaces the value
    expression of a field (used to build malformed test messages).
    """
    overrides = overrides or {}
    cols = []
    for f in schema.fields:
        if f.name not in df.columns:
            continue
        c = F.col(f.name)
        if f.name == "symbol":
            c = normalize_symbol(c)
        elif f.name == "quantity" and quantity_digits is not None:
            c = F.round(c, quantity_digits)
        cols.append(overrides.get(f.name, c).alias(f.name))
    return F.to_json(F.struct(*cols))


def encode_trades(
    df: DataFrame,
    schema: T.StructType = TRADE,
    quantity_digits: int | None = 6,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed trade columns -> binary JSON ``value`` (what the producer sends).

    Columns absent from ``df`` are left out of the message; other columns are
    dropped unless named in ``keep``.
    """
    text = message_json(df, schema, quantity_digits)
    return df.select(text.cast("binary").alias("value"), *keep)
