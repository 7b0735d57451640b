"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when identical after each run of white space becomes one space.
A first scan keeps a narrow key table (length, hash of the first
``PREFIX_CHARS`` characters).  Lengths held by one row drop out, then
(length, prefix) pairs held by one row; the full SHA-256 is taken for the
surviving groups only, by a second scan.  Every group-by sums partial counts
first and the joins back to rows broadcast a counted key table or salt it, so
a group of copies that holds a third of all rows is spread out.

Defined cases: a null text counts as empty, so empty and null texts are one
group; of a group, the row with the smallest ``doc_id`` stays (a null id counts
as larger than any other); of rows that repeat this id and text, one stays; an
empty table gives an empty result; other columns are carried only in ``doc``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import fits_broadcast, look_up, normal_text, settle

PREFIX_CHARS = 256
KEY = ["length_", "prefix_"]


def exact_dedup(docs: DataFrame, digest: bool = False, keep_rows: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``digest``: fill text_sha256 for every row, else only rows whose full text
    had to be compared have it.  ``keep_rows``: add the input row as struct ``doc``.
    """
    columns = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if keep_rows else []
    whole = docs.select(F.col("doc_id"), normal_text().alias("normal_"), *columns)
    keyed = whole.select(
        "*",
        F.octet_length("normal_").alias("length_"),
        F.xxhash64(F.substring("normal_", 1, PREFIX_CHARS)).alias("prefix_"),
    )
    full = F.sha2("normal_", 256)
    unread = keyed.withColumn("text_sha256", full if digest else F.lit(None).cast("string")).drop("normal_")
    narrow = settle(unread.drop("doc"))

    lengths = settle(_repeated(narrow.select("length_"), ["length_"]))
    prefixes = settle(_repeated(look_up(narrow.select(*KEY), lengths, ["length_"], "left_semi"), KEY))

    # Full hashes of the surviving groups, in a stable table with a row number for ties.  Texts are
    # hashed after a broadcast join; where the keys need a shuffle, before it, so that no text moves.
    if fits_broadcast(prefixes):
        hashed = look_up(keyed, prefixes, KEY, "left_semi").withColumn("text_sha256", full)
    else:
        hashed = look_up(keyed.withColumn("text_sha256", full).drop("normal_"), prefixes, KEY, "left_semi")
    survivors = settle(hashed.drop("normal_").withColumn("row_", F.monotonically_increasing_id()))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row_")))
    groups = settle(
        survivors.groupBy(*KEY, "text_sha256")
        .agg(first.alias("first_"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
    )
    compared = look_up(survivors, groups, [*KEY, "text_sha256"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("first_.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | (F.col("row_") == F.col("first_.row_"))).alias("kept"),
        "text_sha256",
        *[c for c in ["doc"] if keep_rows],
    )
    alone = look_up(unread if keep_rows else narrow, prefixes, KEY, "left_anti").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
        *[c for c in ["doc"] if keep_rows],
    )
    return alone.unionByName(compared)


def _repeated(keys: DataFrame, on: list[str]) -> DataFrame:
    """The keys that more than one row holds."""
    return keys.groupBy(*on).agg(F.count(F.lit(1)).alias("rows_")).filter("rows_ > 1").select(*on)


ORACLE = r"""
WITH h AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM h"""
