import random
import re
import zlib
from collections import Counter

import pytest
from awkward import awkward_rows, documents

from tickflow.llm import spelling
from tickflow.llm.spelling import LONGEST, counted, neighbours, variants, with_slips, words_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def one_edit(word):
    """All texts one edit away."""
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in LETTERS}
        if i < len(word):
            out.add(word[:i] + word[i + 1 :])
            out |= {word[:i] + c + word[i + 1 :] for c in LETTERS}
    return out - {word}


def brute_pairs(words):
    known = set(words)
    return {(w, v) for w in known for v in one_edit(w) & known}


def brute(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= 7:
                counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [] for w in counts}
    for w, v in brute_pairs(counts):
        near[w].append(v)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), None if form[w] is None else counts[form[w]]))
    return out


def spelling_rows(seed=0):
    rng = random.Random(seed)
    base = ["letters", "aaaaaaa", "aaaaaaaa", "aabaabaab", "Éternité", "straße" + "nbahn", "ababababab", "q" * LONGEST, "xy" * 40, "rhythms" * 12]
    words = list(base)
    for word in base:
        for _ in range(6):
            i, c = rng.randrange(len(word) + 1), rng.choice("abqxyéÿ")
            words += [word[:i] + c + word[i:], word[:i] + word[i + 1 :], word[:i] + c + word[i + 1 :]]
    rows = [(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(40)]
    rows += [(100 + i, " ".join(["letters letterz", "Letters; letterz"][i % 2] for _ in range(30))) for i in range(4)]
    rows += [(200, "lettorz lettorz " + "letters " * 700 + "letterz," * 40)]
    return rows + [(None, "letters nothing nothing"), (None, None), (7, ""), (300, "x" * 3000 + " " + "x" * 3000 + "-" + "x" * 2999 + " " + "x" * 2999)]


@pytest.mark.parametrize("rows", [spelling_rows(), awkward_rows(), [], [(1, None)]], ids=["spelling", "awkward", "empty", "null"])
def test_variants_match_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(spelling, "LONGEST", 16)
    words = with_slips(words_of(documents(spark, rows).repartition(3)))
    out = variants(counted(words)).collect()
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in out]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_neighbours_of_random_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LONGEST", 20)
    rng = random.Random(5)
    words = {"".join(rng.choice("abÿ") for _ in range(rng.randrange(7, 11))) for _ in range(3000)}
    words |= {"".join(rng.choice("ab") for _ in range(rng.randrange(18, 23))) for _ in range(40)}
    words |= {w[:i] + c + w[i + k :] for w in sorted(words) if len(w) > 17 for i, c, k in [(0, "", 1), (9, "ab", 1), (16, "x", 1), (len(w), "b", 0)]}
    words = {w for w in words if len(w) >= 7}
    got = neighbours(spark.createDataFrame([(w,) for w in words], "word string").repartition(3)).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == brute_pairs(words)
