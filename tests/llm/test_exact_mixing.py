import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from awkward import awkward_rows, documents

from tickflow.llm.exact import exact_dedup
from tickflow.llm.mixing import mix, mixed_documents, random_key

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def _sha(text):
    return hashlib.sha256(BLANK.sub(" ", text or "").encode()).hexdigest()


@pytest.mark.parametrize("digest", [True, False])
def test_exact_matches_brute_force(spark, digest):
    rows = awkward_rows()
    groups = defaultdict(list)
    for r in rows:
        groups[_sha(r[1])].append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    out = exact_dedup(documents(spark, rows), digest=digest).collect()
    assert len(out) == len(rows)
    got = Counter((r.doc_id, r.keep_id, r.group_size) for r in out)
    assert got == Counter((r[0], least[_sha(r[1])], len(groups[_sha(r[1])])) for r in rows)
    assert sum(r.kept for r in out) == len(groups)
    assert all(r.keep_id == r.doc_id for r in out if r.kept)
    if digest:
        assert Counter((r.doc_id, r.text_sha256) for r in out) == Counter((r[0], _sha(r[1])) for r in rows)


def test_exact_keeps_whole_rows(spark):
    rows = awkward_rows()
    docs = documents(spark, rows)
    kept = exact_dedup(docs, keep_rows=True).filter("kept").select("doc.*")
    assert kept.columns == docs.columns
    texts = [_sha(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({_sha(r[1]) for r in rows})


def test_exact_refines_equal_prefixes_and_lengths(spark):
    head = "p" * 300
    rows = [(1, head + "a"), (2, head + "b"), (3, head + "a"), (4, "q" * 301)]
    out = {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in exact_dedup(documents(spark, rows)).collect()}
    assert {k: v[:2] for k, v in out.items()} == {1: (1, 2), 2: (2, 1), 3: (1, 2), 4: (4, 1)}
    assert out[4][2] is None and out[2][2] is not None  # the full text is read only where a prefix repeats


def test_exact_shuffled_keys_give_the_same(spark, monkeypatch):
    rows = awkward_rows()
    a = sorted(map(str, exact_dedup(documents(spark, rows)).drop("kept").collect()))
    monkeypatch.setattr("tickflow.llm.common.BROADCAST_ROWS", 0)
    b = sorted(map(str, exact_dedup(documents(spark, rows)).drop("kept").collect()))
    assert a == b


def test_empty_tables(spark):
    docs = documents(spark, [])
    assert exact_dedup(docs, digest=True).count() == 0
    assert mix(docs).count() == 0
    assert mixed_documents(docs).count() == 0


def _targets(sizes):
    """Water filling in exact arithmetic."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: [1, 2, 3][i % 3] for i, s in enumerate(names)}
    total, open_, target = Fraction(sum(sizes.values())), set(names), {}
    while open_:
        share = {s: total * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not above:
            return target | share
        for s in above:
            target[s] = Fraction(3 * sizes[s])
            total -= target[s]
        open_ -= above
    return target


def test_mix_meets_targets_and_repeats(spark, monkeypatch):
    monkeypatch.setattr("tickflow.llm.mixing.RANGE_ROWS", 4)
    rows = awkward_rows()
    size = lambda t: len((t or "").encode().split())
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size(r[1])
    target = _targets(dict(sizes))
    docs = documents(spark, rows)
    out = mix(docs).collect()
    assert Counter((r.doc_id, r.size, r.source) for r in out) == Counter((r[0], size(r[1]), r[3]) for r in rows)
    taken = defaultdict(int)
    for r in out:
        assert 0 <= r.taken <= 3 * r.size
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(target[r.source]))
        taken[r.source] += r.taken
    for s, t in target.items():
        assert abs(taken[s] - t) <= 3
    assert sorted(map(str, out)) == sorted(map(str, mix(docs.repartition(5)).collect()))
    mixture = mixed_documents(docs)
    assert mixture.columns == docs.columns
    got = defaultdict(int)
    for r in mixture.collect():
        got[r.source] += size(r.text)
    assert got == {k: v for k, v in taken.items() if v}


def test_mix_takes_earlier_keys_first(spark):
    docs = documents(spark, [(i, "w " * 10, None, s) for i, s in enumerate("aabbbbbbcc" * 6)])
    out = mix(docs).withColumn("k", random_key()).collect()
    for s in "abc":
        order = [r.taken for r in sorted((r for r in out if r.source == s), key=lambda r: r.k)]
        assert order == sorted(order, reverse=True)
        assert max(order) - min(order) <= 10
