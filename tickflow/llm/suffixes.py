"""Suffix-array dedup over sparse suffixes: passages that repeat across documents.

Of each text's word suffixes only those at minimisers are kept: positions whose
``GRAM``-word hash is the least of ``SPAN`` neighbouring ones, which depends on
the words alone, so that two copies of a passage keep the same suffixes.  The
suffixes are sorted by the hash of their first ``CERTAIN`` words within buckets
and neighbours are compared: equal ones in several documents are matches.
Matches of a document whose words meet form a run, and matches are extended
left and right, word by word, as far beyond their run as the longer match still
occurs in another document; the longer matches are found by the same sort.

Every passage of at least ``sure_words(…)`` = CERTAIN + SPAN - 1 words that
occurs in two documents is covered whole, and nothing is covered but words of
passages of at least CERTAIN words that do.  With the defaults: 50 and 40.

Defined cases: a null text has no words; repeats within one document (or rows
that share an id) are not passages across documents; null ids count as one
document; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickflow.llm.repeats import (
    BASE_A,
    BASE_B,
    MIX,
    NO_ID,
    Entry,
    Keys,
    Words,
    bucket_count,
    keys_of_texts,
    merged,
    polynomial,
    repeated_keys,
    texts,
    with_keys,
)

GRAM = 6
SPAN = 11
CERTAIN = 40

SPANS = "doc_id long, n_words long, start long, stop long"


def sure_words(span: int = SPAN, certain: int = CERTAIN) -> int:
    return certain + span - 1


def minimisers(hashes: np.ndarray, gram: int, span: int) -> np.ndarray:
    """Positions (rising) whose gram hash is the first least of a window of ``span`` positions."""
    grams = polynomial(hashes, BASE_A, gram)
    if len(grams) < span:
        return np.empty(0, np.int64)
    least = np.zeros(len(grams) - span + 1, np.int64)  # offset of the least in each window
    value = grams[: len(least)].copy()
    for i in range(1, span):
        here = grams[i : i + len(least)]
        lower = here < value
        value[lower] = here[lower]
        least[lower] = i
    return np.unique(least + np.arange(len(least)))


class Kept:
    """The kept suffixes of one text: their starts, and hashes of word ranges from them."""

    def __init__(self, words: list[bytes], gram: int, span: int, certain: int):
        self.n, self.certain = len(words), certain
        self.hashes = Words.get().of(words) if len(words) >= certain else np.empty((0, 2), np.uint64)
        at = minimisers(self.hashes[:, 0], gram, span)
        self.at = at[at + certain <= len(words)]

    def certain_hash(self) -> list[np.ndarray]:
        """Unmixed polynomial of the ``certain`` words from each start, for either hash."""
        if not len(self.at):
            return [np.empty(0, np.uint64)] * 2
        return [polynomial(self.hashes[:, i], base, self.certain, mixed=False)[self.at] for i, base in enumerate(BASES)]

    def longer(self, values: list[np.ndarray], at: np.ndarray, most: int) -> Iterator[tuple[int, int, np.ndarray, list[np.ndarray]]]:
        """Per number of further words to the left, then right: starts it fits, and their mixed hashes."""
        for right in (False, True):
            now = [v.copy() for v in values]
            for more in range(1, most + 1):
                fits = at + self.certain + more <= self.n if right else at >= more
                word = np.where(fits, at + self.certain + more - 1 if right else at - more, 0)
                for i, base in enumerate(BASES):
                    new = self.hashes[:, i][word]
                    now[i] = now[i] * base + new if right else now[i] + new * POWERS[i][self.certain + more - 1]
                yield right, more, fits, [mix(v[fits], self.certain + more) for v in now]


def mix(values: np.ndarray, length: int) -> np.ndarray:
    """Final mixing; ranges of different lengths never look equal by a common polynomial."""
    values = values + POWERS[0][length % len(POWERS[0])]
    return (values ^ (values >> np.uint64(29))) * MIX


BASES = (BASE_A, BASE_B)
POWERS = [np.cumprod(np.concatenate(([np.uint64(1)], np.full(4095, base, np.uint64)))) for base in BASES]


def repeated_passages(docs: DataFrame, gram: int = GRAM, span: int = SPAN, certain: int = CERTAIN) -> DataFrame:
    """doc_id, n_words, start, stop: the maximal word ranges [start, stop) that repeat in other documents.

    Documents without any have no row.
    """
    most = span - 1

    def first_keys(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        a, b = (mix(v, certain) for v in Kept(words, gram, span, certain).certain_hash())
        return a, b

    def longer_keys(batch: pa.RecordBatch) -> Keys:
        """Of the matched suffixes all longer matches are offered; those that would widen a run are wanted."""
        for doc_id, text, found in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("hashes")):
            if not found.is_valid:
                continue
            kept = Kept((text or b"").split(), gram, span, certain)
            values = kept.certain_hash()
            hit = np.isin(mix(values[1], certain).view(np.int64), found.values.to_numpy())
            at, values = kept.at[hit], [v[hit] for v in values]
            runs = np.array(merged(at, at + certain), np.int64).reshape(-1, 2)
            own = np.searchsorted(runs[:, 0], at, "right") - 1
            begins, ends = runs[own, 0], runs[own, 1]
            none = np.empty(0, np.uint64)
            a, b, wanted, note = [none], [none], [none.astype(bool)], [np.empty((0, 3), np.int64)]
            for right, more, fits, hashes in kept.longer(values, at, most):
                reached = (at + certain + more if right else at - more)[fits]
                wide = reached > ends[fits] if right else reached < begins[fits]
                a.append(hashes[0])
                b.append(hashes[1])
                wanted.append(wide)
                note.append(np.stack((own[fits][wide], reached[wide], hashes[1][wide].view(np.int64)), axis=1))
            wants = np.concatenate(note)
            head = np.array([kept.n, len(runs)], np.int64)
            yield Entry(doc_id, np.concatenate(a), np.concatenate(b), np.concatenate(wanted), np.concatenate((head, runs.ravel(), wants.ravel())))

    def extend(ids: np.ndarray, keys: np.ndarray, notes: Iterator[tuple[int, np.ndarray]]) -> pa.Table:
        """Widen the runs of each note to the furthest place whose longer match was found."""
        order = np.argsort(ids, kind="stable")
        ids, keys = ids[order], keys[order]
        out: dict[str, list] = {"doc_id": [], "n_words": [], "start": [], "stop": []}
        for doc_id, note in notes:
            own = keys[np.searchsorted(ids, doc_id, "left") : np.searchsorted(ids, doc_id, "right")]
            words, count = note[:2].tolist()
            runs, wants = note[2 : 2 + 2 * count].reshape(-1, 2).copy(), note[2 + 2 * count :].reshape(-1, 3)
            run, reached, _ = wants[np.isin(wants[:, 2], own)].T
            np.minimum.at(runs[:, 0], run, reached)
            np.maximum.at(runs[:, 1], run, reached)
            for start, stop in merged(runs[:, 0], runs[:, 1]):
                for name, value in zip(out, (None if doc_id == NO_ID else doc_id, words, start, stop)):
                    out[name].append(value)
        return pa.Table.from_pydict({k: pa.array(v, pa.int64()) for k, v in out.items()})

    rows, buckets = texts(docs), bucket_count(docs)
    matched = repeated_keys(rows, keys_of_texts(first_keys), buckets, first_too=True)
    return repeated_keys(with_keys(rows, matched), longer_keys, buckets, first_too=True, answer=extend, schema=SPANS)
