import math
import os
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from tickflow.llm import permutation
from tickflow.llm.common import load
from tickflow.llm.permutation import Block, prefixes, search, usable

SCHEMA = "vec_id long, embedding array<float>, label int, query_id long, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 1) for i, v in rows], SCHEMA)


def run(spark, rows, every=20, **kw):
    vectors = usable(frame(spark, rows), "vec_id", "embedding")
    return search(vectors, vectors.filter(f"vec_id % {every} = 0"), **kw)


def brute(rows, query, k=20):
    table = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            table[i] = min(table.get(i, v), v)
    q = np.array(table[query])
    scored = sorted((-float((np.array(v) * q).sum()), i) for i, v in table.items() if i != query)
    return [(i, -s) for s, i in scored[:k]]


def test_footrule_matches_definition():
    rng = np.random.default_rng(0)
    matrix, pivots = rng.normal(size=(50, 6)), rng.normal(size=(12, 6))
    block = Block(np.arange(50), matrix, pivots, 5)
    lists = prefixes(matrix, pivots, 5)
    place = lambda row: [list(row).index(p) if p in row else 5 for p in range(12)]
    for q in lists[:10]:
        want = [sum(abs(a - b) for a, b in zip(place(q), place(row))) for row in lists]
        assert block.footrule(q).tolist() == want


def test_small_table_is_exact_and_awkward_rows_take_no_part(spark, monkeypatch):
    monkeypatch.setattr(permutation, "BLOCK_VECTORS", 30)
    monkeypatch.setattr(permutation, "CHUNK_QUERIES", 2)
    rng = random.Random(1)
    rows = [(i, [float(rng.randrange(-3, 4)) for _ in range(4)]) for i in range(120)]
    rows += [(20, rows[20][1]), (200, None), (201, [0.0] * 4), (202, [1.0, None, 0.0, 0.0]), (203, [float("nan")] * 4)]
    rows += [(204, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (205, [1.0]), (206, []), *((300 + i, [2.0, 0.0, 1.0, 0.0]) for i in range(40))]
    out = {}
    for r in run(spark, rows).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    known = {i for i, v in rows if i is not None and i % 20 == 0 and v and len(v) == 4 and any(v)} - {200}
    assert set(out) == known
    clean = [(i, v) for i, v in rows if v and len(v) == 4]
    for q, found in out.items():
        assert [r for r, *_ in sorted(found)] == list(range(1, 21))
        assert [(i, s) for _, i, s in sorted(found)] == brute(clean, q)


def test_few_candidates_and_empty(spark):
    out = run(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in out) == [(1, 1, 0.5), (2, 2, -1.0)]
    assert run(spark, [(0, [1.0])]).count() == 0
    assert run(spark, []).count() == 0


def clustered(n, seed=0, width=64):
    """Unit vectors around 100 centres."""
    rng = np.random.default_rng(seed)
    matrix = rng.normal(size=(100, width))[rng.integers(0, 100, n)] + rng.normal(size=(n, width))
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def true_nearest(ids, matrix, at, k=20):
    score = matrix @ matrix[at]
    score[at] = -np.inf
    return set(ids[np.argpartition(-score, k)[:k]].tolist())


@pytest.mark.parametrize("rows, blocks, least", [(None, 1, 0.93), (8_000, 1, 0.9), (8_000, 4, 0.9)])
def test_recall(spark, monkeypatch, rows, blocks, least):
    monkeypatch.setattr(permutation, "LEAST_RERANKED", 400 if rows is None else 1)
    if rows is None:
        vectors = usable(load(spark, "/root/testdata/sf0.1", "embeddings"), "vec_id", "embedding")
    else:
        monkeypatch.setattr(permutation, "BLOCK_VECTORS", -(-rows // blocks))
        made = [(i, v) for i, v in enumerate(clustered(rows).tolist())]
        vectors = usable(spark.createDataFrame(made, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    table = vectors.toPandas()
    ids, matrix = table.vec_id.to_numpy(), np.array(table.vec.tolist())
    found = {}
    for r in search(vectors, vectors.filter("vec_id % 20 = 0")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    wanted = np.flatnonzero(ids % 20 == 0)
    hit = sum(len(true_nearest(ids, matrix, at) & found[int(ids[at])]) for at in wanted)
    assert hit / (20 * len(wanted)) >= least, hit / (20 * len(wanted))


@pytest.mark.parametrize("sf, blocks", [("sf0.1", 1), ("check_s", 1), ("check_l", 4)])
def test_recall_of_the_share_without_the_floor(monkeypatch, sf, blocks):
    path = f"/root/testdata/{sf}/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip(f"no {sf} on this machine; test_recall covers several blocks")
    monkeypatch.setattr(permutation, "LEAST_RERANKED", 1)
    table = pq.read_table(path)
    ids, first = np.unique(table["vec_id"].to_numpy(), return_index=True)
    matrix, rng = np.array(table["embedding"].to_pylist(), np.float64)[first], np.random.default_rng(0)
    assert -(-len(ids) // permutation.BLOCK_VECTORS) == blocks
    pivots, home = matrix[rng.choice(len(ids), permutation.PIVOTS, replace=False)], rng.integers(0, blocks, len(ids))
    parts = [Block(ids[home == b], matrix[home == b], pivots, permutation.PREFIX) for b in range(blocks)]
    wanted = rng.permutation(np.flatnonzero(ids % 20 == 0))[:100]
    hit = 0
    for at, order in zip(wanted, prefixes(matrix[wanted], pivots, permutation.PREFIX)):
        near = [part.nearest(ids[at], matrix[at], order, permutation.RERANKED, 20) for part in parts]
        found = sorted((-s, i) for some, scores in near for i, s in zip(some, scores))[:20]
        hit += len({i for _, i in found} & true_nearest(ids, matrix, at))
    assert hit / (20 * len(wanted)) > 0.9
