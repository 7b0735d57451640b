import hashlib
from collections import Counter, defaultdict

import pytest
from awkward import awkward_rows, documents

from tickflow.llm import repeats
from tickflow.llm.substring import digest, remove_repeats


def brute(rows, window):
    """Per row: words, and for each whether a smaller id holds a window over it."""
    order = lambda i: repeats.NO_ID if i is None else i
    first = {}
    split = [(order(r[0]), (r[1] or "").encode().split()) for r in rows]
    for i, words in split:
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            first[key] = min(first.get(key, i), i)
    for i, words in split:
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            if first[tuple(words[p : p + window])] < i:
                gone[p : p + window] = [True] * window
        yield words, gone


@pytest.mark.parametrize("window, chunk", [(13, 1 << 21), (3, 50), (1, 1 << 21)])
def test_substring_matches_brute_force(spark, monkeypatch, window, chunk):
    monkeypatch.setattr(repeats, "CHUNK_WORDS", chunk)
    rows = awkward_rows()
    out = digest(remove_repeats(documents(spark, rows).repartition(3), window)).collect()
    want = Counter()
    for r, (words, gone) in zip(rows, brute(rows, window)):
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        want[r[0], len(words), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out) == want


def test_spans_are_maximal_and_words_are_exact(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (2, "a b " + text + " c"), (3, text.upper())]
    out = {r.doc_id: r for r in remove_repeats(documents(spark, rows)).collect()}
    assert [(s.start, s.stop) for s in out[2].spans] == [(2, 32)] and out[2].kept_text == "a b c"
    assert out[1].spans == [] and out[3].spans == []


def test_empty(spark):
    assert remove_repeats(documents(spark, [])).count() == 0


def test_vocabulary_may_overflow(monkeypatch):
    monkeypatch.setattr(repeats, "VOCABULARY", 4)
    table = repeats.Words()
    seen = defaultdict(set)
    for words in ([b"a", b"b", b"c"], [b"d", b"e"], [b"a", b"e", b"a"], [b"x", b"y", b"z", b"u", b"v", b"a"]):
        for w, h in zip(words, table.of(words)):
            seen[w].add(tuple(h))
    assert all(len(v) == 1 for v in seen.values())
    assert len({min(v) for v in seen.values()}) == len(seen)
