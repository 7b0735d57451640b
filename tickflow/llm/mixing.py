"""Mixing sources to target weights.

Every document gets a hash-random key.  Per source, keys are cut into ranges of
about ``RANGE_ROWS`` documents; the token counts of the ranges are summed
(partial sums before the shuffle) and their prefix sums give the range in which
the source's budget ends.  Only that one range per source is sorted, which
yields the exact cut: all documents before it are taken once more than those
after it, the document at the cut in part.  Budgets above the source's size
repeat whole epochs.  No text is shuffled, and a source that holds most of the
rows is never in one task.

Defined cases: a null or wordless text has size 0 and takes 0; a null source is
a source of its own, last in order; rows that repeat a ``doc_id`` are documents
of their own, and if the cut falls on them they share it evenly, rounded down;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.common import SPACES, WORD, fits_broadcast, settle, text_or_empty

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
RANGE_ROWS = 16_384
KEY_SALT = "mix:"


def word_count(name: str = "text") -> Column:
    return F.regexp_count(text_or_empty(name), F.lit(WORD)).cast("long")


def random_key(name: str = "doc_id") -> Column:
    """Hash-random key: 32 hex digits, compared as text."""
    return F.md5(F.concat(F.lit(KEY_SALT), F.coalesce(F.col(name).cast("string"), F.lit(""))).cast("binary"))


def _key_32(key: Column) -> Column:
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """One row per source: source, docs, source_size, target.

    Sources in code-point order (null last) weigh ``weights`` in turn and share
    the sum of all sizes; a target stops at ``most_epochs`` times its source's
    size and the excess goes to the others by weight.  With sources ordered by
    cap per unit of weight, the common rate is that of the first source which
    its own cap does not bind.  One row per source passes through here, never
    documents.
    """
    per_source = sized.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(int(w)) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    rows = per_source.withColumn("weight", weight.cast("long")).withColumn("cap", most_epochs * F.col("source_size"))
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rate = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    rated = rows.withColumn("turn", F.row_number().over(by_cap)).withColumn("rate", rate)
    fits = F.when(F.col("rate") <= F.col("cap") / F.col("weight"), F.struct("turn", "rate"))
    rated = rated.withColumn("common", F.min(fits).over(everything)["rate"])
    target = F.least(F.col("cap").cast("double"), F.col("common") * F.col("weight"))
    return rated.select("source", "docs", "source_size", target.alias("target"))


def source_cuts(sized: DataFrame, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """``source_targets`` plus the cut: epochs, cut_key, cut_id, cut_words, cut_docs.

    ``sized`` (settled): doc_id, source, size, key.  A document before
    (cut_key, cut_id) is taken epochs + 1 times, one after it epochs times.
    """
    targets = settle(source_targets(sized, weights, most_epochs))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    plan = (
        targets.withColumn("epochs", epochs)
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
        .withColumn("ranges", F.ceil(F.col("docs") / RANGE_ROWS).cast("long"))
    )
    ranged = join_source(sized, plan.select("source", "rest", "ranges")).withColumn(
        "range", F.shiftright(_key_32(F.col("key")) * F.col("ranges"), 32)
    )
    sums = ranged.groupBy("source", "range", "rest").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The budget ends in the range that first passes it; one row per source.
    ends = (
        sums.withColumn("after", F.sum("words").over(upto))
        .filter((F.col("after") > F.col("rest")) & (F.col("after") - F.col("words") <= F.col("rest")))
        .select("source", "range", (F.col("after") - F.col("words")).alias("ahead"))
    )
    ends = settle(ends)
    last = join_source(ranged, ends.withColumnRenamed("range", "end_range")).filter(F.col("range") == F.col("end_range"))
    by_doc = last.groupBy("source", "rest", "ahead", "key", "doc_id").agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("cut_docs")
    )
    sorted_docs = Window.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_last())
    prior = F.coalesce(F.sum("words").over(sorted_docs.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = by_doc.withColumn("prior", F.col("ahead") + prior).filter(
        (F.col("prior") <= F.col("rest")) & (F.col("prior") + F.col("words") > F.col("rest"))
    )
    cuts = at.select(
        "source",
        F.col("key").alias("cut_key"),
        F.col("doc_id").alias("cut_id"),
        (F.col("rest") - F.col("prior")).alias("cut_words"),
        "cut_docs",
    )
    return settle(join_source(plan.select("source", "source_size", "target", "epochs"), cuts, "left"))


def join_source(rows: DataFrame, per_source: DataFrame, how: str = "inner") -> DataFrame:
    """Join on source, null equal to null; broadcast only a counted, bounded number of sources."""
    right = per_source.withColumnRenamed("source", "source_")
    if fits_broadcast(per_source):
        right = F.broadcast(right)
    return rows.join(right, F.col("source").eqNullSafe(F.col("source_")), how).drop("source_")


def taken_words() -> Column:
    """Words that the mix takes of a row that has size, key, doc_id and its source's cut."""
    key, cut = F.col("key"), F.col("cut_key")
    at_cut = (key == cut) & F.col("doc_id").eqNullSafe(F.col("cut_id"))
    earlier = (key < cut) | ((key == cut) & (F.col("doc_id") < F.col("cut_id")))
    share = F.least(F.col("size"), F.floor(F.col("cut_words") / F.col("cut_docs")))
    # Without a cut the source's whole epochs are all there is.
    extra = F.when(at_cut, share).when(earlier, F.col("size")).otherwise(0)
    return (F.col("epochs") * F.col("size") + extra).cast("long")


def sized_documents(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count().alias("size"), random_key().alias("key"))


def mix(docs: DataFrame, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: one row per document."""
    sized = settle(sized_documents(docs))
    cut = join_source(sized, source_cuts(sized, weights, most_epochs))
    return cut.select("doc_id", "source", "size", "source_size", "target", taken_words().alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """The mixture itself: the columns of ``docs``, each row as often as it is taken.

    The document at a source's cut comes with its first words only, joined by
    one space.  The cut table is small, so this is one map-only pass.
    """
    sized = settle(sized_documents(docs))
    cuts = source_cuts(sized, weights, most_epochs)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        "doc_id",
        "source",
        word_count().alias("size"),
        random_key().alias("key"),
    )
    taken = join_source(rows, cuts).withColumn("taken", taken_words()).filter("taken > 0")
    whole, part = F.floor(F.col("taken") / F.col("size")).cast("int"), (F.col("taken") % F.col("size")).cast("int")
    copies = F.concat(
        F.array_repeat(F.lit(None).cast("int"), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>"))
    )
    out = taken.withColumn("first_words", F.explode(copies))
    words = F.split(F.trim(F.regexp_replace(F.col("doc.text"), SPACES, " ")), " ")
    cut_text = F.when(F.col("first_words").isNull(), F.col("doc.text")).otherwise(
        F.array_join(F.slice(words, F.lit(1), F.col("first_words")), " ")
    )
    return out.withColumn("cut_text", cut_text).select(
        *[F.col("cut_text").alias("text") if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    )


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, 3 * source_size AS cap, row_number() OVER w AS turn,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER () - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS rate
  FROM per_source WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, (SELECT arg_min(rate, turn) FROM ordered WHERE rate <= cap / weight) * weight) AS target
  FROM ordered),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs FROM targets),
ranked AS (
  SELECT s.*, b.source_size, b.target, b.epochs, floor(b.target)::BIGINT - b.epochs * b.source_size AS rest,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, source, size, source_size, target,
       (epochs * size + greatest(0, least(size, rest - prior)))::BIGINT AS taken
FROM ranked"""
