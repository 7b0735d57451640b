"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.session import work_dir

# The white space that separates words and is folded in normalised texts.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Broadcast bound: key tables of at most so many rows of a few longs each
# (some tens of MB as a hash table).  Beyond it, salted shuffle joins.
BROADCAST_ROWS = 400_000
SALTS = 16


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder and read it there."""
    work_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fits_broadcast(keys: DataFrame) -> bool:
    """A count shows that the key table is small enough to broadcast."""
    return keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def look_up(big: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join ``big`` to a table of distinct keys (``left``, ``inner``, ``left_semi``, ``left_anti``).

    The key table is broadcast only when a count shows at most
    ``BROADCAST_ROWS`` rows.  Otherwise both sides are shuffled on the key and a
    salt, with the key table repeated once per salt, so that a key that holds
    a third of all rows is spread over ``SALTS`` tasks.  ``keys`` should be
    settled, since the count runs it once.
    """
    if fits_broadcast(keys):
        return big.join(F.broadcast(keys), on, how)
    salted = big.withColumn("salt_", F.floor(F.rand(7) * SALTS).cast("int"))
    spread = keys.withColumn("salt_", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return salted.join(spread, [*on, "salt_"], how).drop("salt_")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def normal_text(name: str = "text") -> Column:
    """The text with each run of white space replaced by one space; null counts as empty."""
    return F.regexp_replace(text_or_empty(name), SPACES, " ")
