"""Substring dedup: repeated fixed-length word windows, removed as maximal intervals.

Every window of ``WINDOW`` consecutive words of every whole text is hashed
(Rabin-Karp) and the windows are counted in Spark by ``repeats.repeated_keys``.
A window whose words also start in a document with a smaller id is a repeat;
repeats of a document merge into maximal intervals of words, which are removed.
Windows are judged on the input.  Equality is that of two independent hashes of
together more than 64 bits (the key and the bucket, which grows with the data).

Defined cases: a null text has no words; fewer words than a window: nothing
repeats; rows that share a ``doc_id`` never repeat each other; a null id counts
as larger than any other, and null ids never repeat each other; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.repeats import BASE_A, BASE_B, Words, bucket_count, keys_of_texts, merged, polynomial, repeated_keys, texts, with_keys

WINDOW = 13
SCHEMA = "doc_id long, n_words long, spans array<struct<start:long,stop:long>>, kept_text string"


def _window_keys(window: int):
    def keys(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(words) < window:
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        hashes = Words.get().of(words)
        return polynomial(hashes[:, 0], BASE_A, window), polynomial(hashes[:, 1], BASE_B, window)

    return keys


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, spans (removed [start, stop) in words), kept_text (words joined by one space)."""
    keys = _window_keys(window)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"doc_id": batch.column("doc_id").to_pylist(), "n_words": [], "spans": [], "kept_text": []}
            flags = batch.column("hashes")
            for i, text in enumerate(batch.column("text").to_pylist()):
                words, spans = (text or b"").split(), []
                if flags[i].is_valid and len(words) >= window:
                    repeats = np.flatnonzero(np.isin(keys(words)[1].view(np.int64), flags[i].values.to_numpy()))
                    spans = merged(repeats, repeats + window)
                kept, at = [], 0
                for start, stop in spans:
                    kept += words[at:start]
                    at = stop
                kept += words[at:]
                out["n_words"].append(len(words))
                out["spans"].append([{"start": a, "stop": b} for a, b in spans])
                out["kept_text"].append(b" ".join(kept))
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["doc_id"], pa.int64()),
                    pa.array(out["n_words"], pa.int64()),
                    pa.array(out["spans"], span),
                    pa.array(out["kept_text"], pa.binary()).cast(pa.string()),
                ],
                names=list(out),
            )

    rows = texts(docs)
    found = repeated_keys(rows, keys_of_texts(keys), bucket_count(docs), first_too=False)
    return with_keys(rows, found).mapInArrow(cut, SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of ``remove_repeats``."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
word AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos,
         unnest(list_transform(range(1, len(words) + 1),
                lambda i: CASE WHEN i + 12 <= len(words) THEN array_to_string(words[i:i + 12], ' ') END)) AS words_from
  FROM split),
judged AS (
  SELECT *, CASE WHEN words_from IS NOT NULL AND min(doc_id) OVER (PARTITION BY words_from) < doc_id THEN 1 ELSE 0 END AS repeats
  FROM word),
covered AS (
  SELECT doc_id, pos, word, max(repeats) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone
  FROM judged),
kept AS (
  SELECT doc_id, count(*) AS n_words, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone = 0) AS kept
  FROM covered GROUP BY doc_id)
SELECT s.doc_id, coalesce(k.n_words, 0) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM split s LEFT JOIN kept k USING (doc_id)"""
