"""Corpus pipeline: five of the training-data operators in a row over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``.  ``run`` writes each
stage's result as Parquet into the shared folder and reads it again, so a lost
executor repeats at most one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickflow.llm.common import load, look_up, settle
from tickflow.llm.exact import exact_dedup
from tickflow.llm.langid import identified_documents
from tickflow.llm.mixing import mixed_documents
from tickflow.llm.packing import pack
from tickflow.llm.simhash import simhash_near_dedup
from tickflow.operators.store import _delete
from tickflow.session import scratch_path

# Language ID learns profiles and tokenizers run outside SQL; tested against a brute-force version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, which have no language."""
    return identified_documents(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return exact_dedup(docs, keep_rows=True).filter("kept").select("doc.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate component the document with the smallest doc_id stays.

    Rows without an id belong to no component and stay; rows that repeat the id that stays, stay.
    """
    gone = settle(simhash_near_dedup(docs).filter("component_id <> doc_id").select("doc_id").distinct())
    return look_up(docs, gone, ["doc_id"], "left_anti").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeat as often as the mix takes them; the one at a source's cut comes in part."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("mixing", mixture),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's result."""
    docs = load(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        if before:
            _delete(spark, before)  # the input of a stage whose result is written
        before = path
    return docs
