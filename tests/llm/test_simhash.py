import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from awkward import awkward_rows, documents
from pyspark.sql import functions as F

from tickflow.llm import simhash
from tickflow.llm.simhash import Forest, components, fingerprint_of, shard_links, simhash_near_dedup


def brute_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs, radius=4):
    """pairs: (doc_id, fingerprint); union by rows within the radius and by equal id."""
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i, (d, f) in enumerate(pairs):
        for e, g in pairs[: i + 1]:
            if bin(f ^ g).count("1") <= radius:
                a, b = sorted((find(d), find(e)))
                parent[b] = a
    return {d: find(d) for d, _ in pairs}


def test_fingerprint_matches_definition(spark):
    rows = awkward_rows()
    for r in rows:
        if r[1] is None or len(r[1]) < 5000:
            want = brute_fingerprint(r[1])
            assert fingerprint_of(None if r[1] is None else r[1].encode()) % (1 << 64) == want


def test_whole_operator_matches_brute_force(spark):
    rows = [r for r in awkward_rows() if r[1] is None or len(r[1]) < 5000]
    out = simhash_near_dedup(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    want = brute_components([(r[0], brute_fingerprint(r[1])) for r in rows if r[0] is not None])
    assert sorted((r.doc_id, r.fingerprint) for r in out if r.doc_id is not None) == sorted(
        (r[0], f"{brute_fingerprint(r[1]):016x}") for r in rows if r[0] is not None
    )
    for r in out:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])


def _near(rng, centres, n):
    out = set()
    while len(out) < n:
        f = rng.choice(centres)
        for b in rng.sample(range(64), rng.randrange(8)):
            f ^= 1 << b
        out.add(f)
    return sorted(out)


@pytest.mark.parametrize("seed, radius", [(0, 4), (1, 4), (2, 2), (3, 6)])
def test_forest_classes_match_all_pairs(seed, radius):
    rng = random.Random(seed)
    shards, fps = [], []
    for s, (centres, n) in enumerate([(1, 200), (40, 300), (3, 1), (2, 2), (5, 150)]):
        values = _near(rng, [rng.getrandbits(64) for _ in range(centres)], n)
        rng.shuffle(values)
        shards += [s] * n
        fps += values
    label = Forest(np.array(shards), np.array(fps, np.uint64)).classes(radius)
    for s in set(shards):
        own = [i for i in range(len(fps)) if shards[i] == s]
        want = brute_components([(i, fps[i]) for i in own], radius)
        assert {i: int(label[i]) for i in own} == want


@pytest.mark.parametrize("batch", [7, 10_000])
def test_shards_lose_no_link(spark, batch):
    rng = random.Random(5)
    fps = _near(rng, [rng.getrandbits(64) for _ in range(60)], 600)
    ids = rng.sample(range(10_000), len(fps))
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        links = shard_links(spark.createDataFrame(list(zip(signed, ids)), "fp long, vertex long"))
        roots = {r.vertex: r.root for r in components(links).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute_components(list(zip(ids, fps)))
    assert {i: roots.get(i, i) for i in ids} == want


@pytest.mark.parametrize("seed, most", [(1, 40), (2, 100), (3, 3)])
def test_hot_shards_are_dealt_again_and_lose_no_link(spark, seed, most):
    rng = random.Random(seed)
    # Families that agree on half of the bits, so several shards of every member are hot.
    family = [rng.getrandbits(32) | 0xDEADBEEF << 32 for _ in range(60)]
    fps = sorted({f ^ sum(1 << b for b in rng.sample(range(32), rng.randrange(7))) for f in family * 8} | {rng.getrandbits(64) for _ in range(50)})
    ids = rng.sample(range(10_000), len(fps))
    rows = spark.createDataFrame([(f - (1 << 64) if f >= 1 << 63 else f, i) for f, i in zip(fps, ids)], "fp long, vertex long")
    roots = {r.vertex: r.root for r in components(shard_links(rows, most=most)).collect()}
    assert {i: roots.get(i, i) for i in ids} == brute_components(list(zip(ids, fps)))


def test_finer_masks_fix_more_bits_and_cover_all():
    for mask in (0, simhash._finer(0, 4)[3], simhash._finer(simhash._finer(0, 4)[14], 4)[7]):
        finer = simhash._finer(mask, 4)
        assert len(finer) == 15 and all(f & mask == mask and f != mask for f in finer)
        assert int(np.bitwise_or.reduce(np.array(finer, np.uint64))) == (1 << 64) - 1


def test_dense_group_emits_no_all_pairs(spark):
    rng = random.Random(9)
    fps = _near(rng, [0x0123456789ABCDEF], 400)
    rows = [(f, i) for i, f in enumerate(fps)]
    assert shard_links(spark.createDataFrame([(f if f < 1 << 63 else f - (1 << 64), i) for f, i in rows], "fp long, vertex long")).count() < 15 * 400


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100 + i, 100) for i in range(1, 60)] + [(200, 201), (201, 200), (300, 300)]
    got = defaultdict(set)
    for r in components(spark.createDataFrame(edges, "a long, b long")).collect():
        got[r.root].add(r.vertex)
    assert {k: v - {k} for k, v in got.items()} == {0: set(range(1, 41)), 100: set(range(101, 160)), 200: {201}}


def test_empty_and_ids(spark):
    assert simhash_near_dedup(documents(spark, [])).count() == 0
    out = simhash_near_dedup(documents(spark, [(4, ""), (2, None), (9, "x")]))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in out.collect()}[4] == ("0" * 16, 2)
    assert simhash.RADIUS == 4 and out.filter(F.length("fingerprint") != 16).count() == 0
