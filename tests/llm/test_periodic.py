import hashlib
import random
import zlib

import numpy as np
import pytest
from awkward import awkward_rows, documents

from tickflow.llm.periodic import SuffixTree, digest, periodic_runs, planted_words, runs_of, runs_of_words, stretches


def brute_runs(s, least=12):
    """Every period's maximal stretches, smallest periods only."""
    found = set()
    for q in range(1, len(s) // 2 + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                own = s[i : j + q]
                if not any(own[r:] == own[:-r] for r in range(1, q)):
                    found.add((i, q, j + q - i))
            i = j + 1
    return [(b, n, q) for b, q, n in sorted(found)]


def plant(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def expected(doc_id, text, least=12):
    words = plant(doc_id, (text or "").encode().split())
    runs = brute_runs(words, least)
    gone = set()
    for b, n, q in runs:
        gone.update(range(b + q, b + n))
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    listed = "".join(f"{b},{n},{q}\n" for b, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    milli = None if top[0] is None else 1000 * top[1] // top[2]
    return (doc_id, len(runs), *top, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def random_texts(n, seed=0):
    rng = random.Random(seed)
    for _ in range(n):
        k = rng.choice([1, 2, 3, 5])
        s = [rng.randrange(k) for _ in range(rng.randrange(60))]
        if s and rng.random() < 0.5:
            a, p = rng.randrange(len(s)), rng.randrange(1, 9)
            s = s[:a] + [s[a + (i - a) % p] if a + (i - a) % p < len(s) else 0 for i in range(a, len(s))]
        yield s


@pytest.mark.parametrize("least", [12, 5, 2])
def test_runs_match_brute_force(least):
    for s in random_texts(500, least):
        words = [b"%d" % x for x in s]
        assert [tuple(r) for r in runs_of_words(words, least).tolist()] == brute_runs(s, least)
        if s:
            assert [tuple(r) for r in runs_of([x + 1 for x in s], least).tolist()] == brute_runs(s, least)


def test_fibonacci_word_has_many_runs():
    a, b = "a", "ab"
    while len(b) < 1500:
        a, b = b, b + a
    s = [ord(c) for c in b]
    assert [tuple(r) for r in runs_of_words([b"%d" % x for x in s]).tolist()] == brute_runs(s)


def test_tree_extensions_and_ranks():
    for s in random_texts(60, 9):
        if len(s) < 2:
            continue
        s = [x + 1 for x in s]
        tree = SuffixTree(s)
        order = sorted(range(len(s) + 1), key=lambda i: [*s[i:], 0])
        assert tree.rank.tolist() == np.argsort(order).tolist()
        pairs = [(i, j) for i in range(len(s)) for j in range(len(s)) if i != j]
        got = tree.extension(*map(np.array, zip(*pairs)))
        for (i, j), n in zip(pairs, got.tolist()):
            want = 0
            while max(i, j) + want < len(s) and s[i + want] == s[j + want]:
                want += 1
            assert n == want


def test_stretches_hold_every_run():
    for s in random_texts(300, 4):
        held = stretches(np.array(s, np.int64))
        for b, n, _ in brute_runs(s):
            assert any(x <= b and b + n <= y for x, y in held)


def run_rows():
    rng = random.Random(2)
    rows = []
    for i in range(120):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(120))]
        if i % 3 == 0:
            at = rng.randrange(len(words) + 1)
            words[at:at] = [f"r{x}" for x in range(rng.randrange(1, 9))] * rng.randrange(2, 9)
        rows.append((i, " \n".join(words)))
    return rows + [(500, "tick " * 6000), (None, "tick " * 12), (3, rows[3][1]), (501, "a b c d e f a b c d e f"), (502, "a " * 11)]


@pytest.mark.parametrize("rows", [run_rows(), [r for r in awkward_rows() if len(r[1] or "") < 20_000], []], ids=["runs", "awkward", "empty"])
def test_query_matches_brute_force(spark, rows):
    out = digest(periodic_runs(documents(spark, rows).repartition(3), words_of=planted_words)).collect()
    got = sorted(map(tuple, out), key=repr)
    assert got == sorted((expected(r[0], r[1]) for r in rows), key=repr)


def test_plain_documents_stay_as_they_are(spark):
    rows = [(i, f"{i} " + " ".join(f"w{j}" for j in range(50))) for i in range(40)] + [(99, "ha " * 20 + "end")]
    out = {r.doc_id: r for r in periodic_runs(documents(spark, rows)).collect()}
    assert all(out[i].runs == [] and out[i].collapsed_text == rows[i][1] for i in range(40))
    assert [tuple(r) for r in out[99].runs] == [(0, 20, 1)] and out[99].collapsed_text == "ha end" and out[99].n_words == 21
