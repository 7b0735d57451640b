"""The registered queries of the operators, with DuckDB text where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickflow.llm import (
    exact,
    langid,
    licenses,
    lines,
    mixing,
    packing,
    periodic,
    permutation,
    secrets,
    simhash,
    spelling,
    substring,
    suffixes,
)
from tickflow.llm.common import load


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = permutation.usable(load(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return permutation.search(vectors, vectors.filter("vec_id % 20 = 0"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(load(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(load(spark, sf_dir, "documents"), digest=True)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_near_dedup(load(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(load(spark, sf_dir, "documents")))


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(load(spark, sf_dir, "documents"))


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(substring.remove_repeats(load(spark, sf_dir, "documents")))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "stop", "rule", "score", "is_secret")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(lines.remove_repeated_lines(load(spark, sf_dir, "documents")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.periodic_runs(load(spark, sf_dir, "documents"), words_of=periodic.planted_words))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.with_slips(spelling.words_of(load(spark, sf_dir, "documents")))
    return spelling.variants(spelling.counted(words))


def llm_registry() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    """name -> (Spark callable, DuckDB oracle text or None)."""
    return {
        "op1_permutation_index": (op1_permutation_index, None),
        "op2_language_id": (op2_language_id, None),
        "op3_exact_dedup": (op3_exact_dedup, exact.ORACLE),
        "op4_simhash": (op4_simhash, None),
        "op5_packing": (op5_packing, None),
        "op6_licenses": (op6_licenses, licenses.oracle()),
        "op7_suffix_array": (op7_suffix_array, None),
        "op8_substring": (op8_substring, substring.ORACLE),
        "op9_secrets": (op9_secrets, None),
        "op10_mixing": (op10_mixing, mixing.ORACLE),
        "op11_line_dedup": (op11_line_dedup, lines.ORACLE),
        "op12_periodic_runs": (op12_periodic_runs, None),
        "op13_spelling": (op13_spelling, None),
    }
