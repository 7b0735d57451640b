"""Language identification by rank-order profiles of character n-grams.

Words are maximal runs of letters, lower-cased and padded by one blank; the
n-grams of one to three characters are counted within padded words.  A
language's profile is its ``PROFILE_GRAMS`` most frequent n-grams over all
training texts.  A document's own most frequent n-grams are compared to every
profile: the out-of-place distance sums, over the document's n-grams, how far
the rank in the profile is from the rank in the document, and the full profile
length for an n-gram that the profile lacks.

Learning counts each document in the task that reads it and sums the counts in
Spark; only the finished profiles (languages x PROFILE_GRAMS rows) reach the
driver.  Prediction is one pass over whole texts with the profiles at hand.

Defined cases: a null text or one without a letter is ``und`` with score 0, as
is everything when no language was learned; ranks of equal counts go by code
point, equal distances by language code; rows with a null language are not
learned from; rows that repeat count each time; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROFILE_GRAMS = 400
UNKNOWN = "und"
BLANK = 1
SLICE = 1 << 18  # characters counted at a time
MERGE = 1 << 20  # n-gram rows held per language before they are merged
MOST_LANGUAGES = 10_000  # profiles are sent to every task

Profiles = dict[str, list[int]]


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _sum_counts(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.empty(0, np.int64)
    return codes[starts], np.add.reduceat(counts, starts) if len(codes) else counts


def gram_counts(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes (21 bits a character, a blank is 1) in rising order, and their counts."""
    lowered = (text or b"").decode("utf-8", "replace").lower()
    points = np.frombuffer(lowered.encode("utf-32-le", "replace"), np.uint32)
    points = np.where(_letters()[points], points, BLANK).astype(np.uint64)
    edge = np.full(1, BLANK, np.uint64)
    points = np.concatenate((edge, points, edge))
    points = points[np.concatenate(([True], (points[1:] != BLANK) | (points[:-1] != BLANK)))]
    parts = []
    bits = np.uint64(21)
    for at in range(0, max(0, len(points) - 1), SLICE):
        a = points[at : at + SLICE + 2]
        here = a[:SLICE]
        pairs = (a[:-1] << bits) | a[1:]
        inner = a[1:-1] != BLANK
        triples = ((pairs[:-1] << bits) | a[2:])[inner]
        codes = np.sort(np.concatenate((here[here != BLANK], pairs[:SLICE], triples)))
        starts = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        parts.append((codes[starts], np.diff(np.concatenate((starts, [len(codes)])))))
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(parts) == 1:
        return parts[0]
    return _sum_counts(*map(np.concatenate, zip(*parts)))


def top_grams(codes: np.ndarray, counts: np.ndarray, most: int = PROFILE_GRAMS) -> np.ndarray:
    """Codes by falling count, equal counts by code."""
    if len(counts) > 4 * most:
        floor = np.partition(counts, len(counts) - most)[len(counts) - most]
        keep = counts >= floor
        codes, counts = codes[keep], counts[keep]
    return codes[np.argsort(-counts, kind="stable")][:most]


def learn_profiles(labelled: DataFrame, most: int = PROFILE_GRAMS) -> Profiles:
    """Profiles from ``text`` and ``lang`` of every row with a language: lang -> ranked codes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = defaultdict(list)

        def merged(lang: str) -> pa.RecordBatch:
            codes, counts = _sum_counts(*map(np.concatenate, zip(*held.pop(lang))))
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes)), pa.array(codes.view(np.int64)), pa.array(counts, pa.int64())],
                names=["lang", "gram", "n"],
            )

        size: dict[str, int] = defaultdict(int)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                found = gram_counts(text)
                held[lang].append(found)
                size[lang] += len(found[0])
                if size[lang] > MERGE:
                    held[lang] = [_sum_counts(*map(np.concatenate, zip(*held[lang])))]
                    if len(held[lang][0][0]) > MERGE // 2:
                        yield merged(lang)
                    size[lang] = sum(len(c) for c, _ in held.get(lang, []))
        for lang in list(held):
            yield merged(lang)

    rows = labelled.filter("lang IS NOT NULL").select("lang", F.col("text").cast("binary").alias("text"))
    totals = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = totals.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")))
    ranked = ranked.filter(F.col("rank") <= most).select("lang", "rank", "gram")
    profiles: Profiles = defaultdict(list)
    for lang, _rank, gram in sorted(ranked.limit(MOST_LANGUAGES * most + 1).collect()):
        profiles[lang].append(gram)
    if len(profiles) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return dict(profiles)


class Judge:
    """Out-of-place distances to all profiles at once."""

    def __init__(self, profiles: Profiles, most: int = PROFILE_GRAMS):
        self.langs, self.most = sorted(profiles), most
        known = sorted({g for ranked in profiles.values() for g in ranked})
        self.known = np.asarray(known, np.int64).view(np.uint64)
        self.ranks = np.full((len(known) + 1, len(self.langs)), -1, np.int64)
        place = {g: i for i, g in enumerate(known)}
        for j, lang in enumerate(self.langs):
            for rank, gram in enumerate(profiles[lang]):
                self.ranks[place[gram], j] = rank

    def predict(self, text: bytes | None) -> tuple[str, float]:
        return self.judge(text)[:2]

    def judge(self, text: bytes | None) -> tuple[str, float, bool]:
        top = top_grams(*gram_counts(text), self.most)
        if not len(top) or not self.langs:
            return UNKNOWN, 0.0, len(top) > 0
        at = np.searchsorted(self.known, top)
        at[self.known[np.minimum(at, len(self.known) - 1)] != top] = len(self.known)
        ranks = self.ranks[at]
        away = np.where(ranks < 0, self.most, np.abs(ranks - np.arange(len(top))[:, None])).sum(axis=0)
        best = int(np.argmin(away))
        return self.langs[best], 1.0 - float(away[best]) / (self.most * len(top)), True


def predicted(profiles: Profiles, text: Column, most: int = PROFILE_GRAMS) -> Column:
    """Struct lang_pred, score, lettered (whether it has a letter) of a text column."""

    @F.pandas_udf("lang_pred string, score double, lettered boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        judge = Judge(profiles, most)
        for texts in batches:
            rows = [judge.judge(t) for t in texts]
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "lettered"]).astype({"score": "float64", "lettered": "bool"})

    return predict(text.cast("binary"))


def held_out() -> Column:
    """Documents that learning never sees: crc32 of the id as text leaves 1 modulo 3."""
    remainder = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3
    return remainder == 1


def identify(docs: DataFrame, most: int = PROFILE_GRAMS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learned from those not held out."""
    profiles = learn_profiles(docs.filter(~held_out()), most)
    found = docs.select("doc_id", held_out().alias("held_out"), predicted(profiles, F.col("text"), most).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def identified_documents(docs: DataFrame, least_score: float = 0.0, most: int = PROFILE_GRAMS) -> DataFrame:
    """The columns of ``docs`` for documents with a letter that score at least ``least_score``.

    A text whose n-grams no profile has scores 0, as does every text where no
    language was learned: both stay unless ``least_score`` is above 0.
    """
    profiles = learn_profiles(docs.filter(~held_out()), most)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    judged = rows.withColumn("p", predicted(profiles, F.col("doc.text"), most))
    kept = judged.filter(F.col("p.lettered") & (F.col("p.score") >= least_score))
    return kept.select("doc.*")
