import random
from collections import defaultdict

import numpy as np
import pytest
from awkward import awkward_rows, documents

from tickflow.llm import repeats
from tickflow.llm.suffixes import minimisers, repeated_passages, sure_words


def repeated_cover(rows, length):
    """Per row: words inside a window of ``length`` words that another document holds."""
    holders = defaultdict(set)
    split = [(r[0], (r[1] or "").encode().split()) for r in rows]
    for i, words in split:
        for p in range(len(words) - length + 1):
            holders[tuple(words[p : p + length])].add(i)
    for _, words in split:
        covered = np.zeros(len(words), bool)
        for p in range(len(words) - length + 1):
            if len(holders[tuple(words[p : p + length])]) > 1:
                covered[p : p + length] = True
        yield covered


def check(spark, rows, gram, span, certain):
    out = repeated_passages(documents(spark, rows).repartition(3), gram, span, certain).collect()
    by_doc = defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) <= {r[0] for r in rows}
    ids = [r[0] for r in rows]
    sure, least = repeated_cover(rows, sure_words(span, certain)), repeated_cover(rows, certain)
    n = 0
    for r, must, may in zip(rows, sure, least):
        if ids.count(r[0]) > 1:
            continue
        got = np.zeros(len(must), bool)
        for s in by_doc[r[0]]:
            assert s.n_words == len(must)
            got[s.start : s.stop] = True
            assert s.stop - s.start >= certain
        assert not (must & ~got).any() and not (got & ~may).any()
        n += int(got.sum())
    return n


@pytest.mark.parametrize("gram, span, certain, chunk", [(6, 11, 40, 1 << 20), (2, 4, 5, 60), (3, 1, 8, 1 << 20)])
def test_between_sure_and_certain(spark, monkeypatch, gram, span, certain, chunk):
    monkeypatch.setattr(repeats, "CHUNK_WORDS", chunk)
    assert check(spark, awkward_rows(), gram, span, certain) > 100


@pytest.mark.parametrize("seed", [1, 2])
def test_random_overlapping_passages(spark, seed):
    rng = random.Random(seed)
    passages = [[f"p{k}_{j}" for j in range(rng.randrange(6, 40))] for k in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(6)):
            words += [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(8))]
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            words += p[a : a + rng.randrange(3, 40)]
        rows.append((i, " ".join(words)))
    assert check(spark, rows, 2, 4, 8) > 500


def test_minimisers_are_least_of_a_window():
    hashes = np.random.default_rng(0).integers(0, 1 << 62, 300).astype(np.uint64)
    got = minimisers(hashes, 3, 7)
    grams = repeats.polynomial(hashes, repeats.BASE_A, 3)
    assert got.tolist() == sorted({j + int(np.argmin(grams[j : j + 7])) for j in range(len(grams) - 6)})


def test_empty(spark):
    assert repeated_passages(documents(spark, [])).count() == 0
