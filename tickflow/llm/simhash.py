"""SimHash near-dedup: fingerprints linked within a Hamming radius through BK-trees.

Fingerprint: over a document's word shingles (repeats included) a bit is 1 if
it is set in more than half of the shingles' 64-bit hashes.

Links: the distinct fingerprints are sharded by agreement.  Of ``radius + 2``
bit blocks, two fingerprints within the radius agree on at least two, so they
meet in the shard of one pair of blocks; no link is lost.  A shard of more than
``MOST_IN_TREE`` fingerprints is dealt again in the same way by its other bits.
A shard's fingerprints form a BK-tree: children are keyed by their integer Hamming
distance to the parent, and a search follows only edges whose key lies within
the radius of its own distance to the node.  The trees of all shards that a
task holds are built and searched together, level by level.  The set of trees
grows with the data, so trees are co-located with their queries by a shuffle on
the shard key instead of being broadcast.

A shard emits one link per fingerprint, to the least member of its class there,
never all pairs: subtrees below an edge within the radius are linked to the
node at once, and a search skips subtrees whose members are all in the
searcher's class already.  Classes across shards are joined by large-star /
small-star rounds on Spark tables, cut by checkpoints.

Defined cases: a null, empty or wordless text has fingerprint zero, linked like
any other; fewer words than a shingle count as one shingle; rows that repeat a
``doc_id`` are one vertex, and the repeat's fingerprint links too; a null id
has a fingerprint but no component; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import look_up, settle

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
SLICE = 1 << 16  # hashes unpacked to bits at a time
MOST_IN_TREE = 1 << 16  # fingerprints; a larger shard is dealt again by its free bits


# --- fingerprints -------------------------------------------------------------


def fingerprint_of(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    words = (text or b"").lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle_words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-shingle_words])).tolist()
        stops = (ends[shingle_words - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, stops)]
    table = np.asarray(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(table), SLICE):
        bits = np.unpackbits(table[at : at + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(table), bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long), one row per row of ``docs``."""

    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(t, shingle_words) for t in texts], dtype="int64")

    return docs.select("doc_id", fp(F.col("text").cast("binary")).alias("fp"))


# --- BK-trees of a task's shards ------------------------------------------------


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Forest:
    """One BK-tree per shard over the fingerprints of several shards, in numpy.

    ``parent``, ``edge`` (distance to the parent) and ``root`` are per member;
    the children of a node are found by the sorted key ``parent * 65 + edge``.
    """

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        n = len(fp)
        self.fp, self.parent, self.edge, self.root = fp, np.full(n, -1), np.zeros(n, np.int64), np.arange(n)
        self.levels: list[np.ndarray] = []
        waiting = np.arange(n)
        group = np.unique(shard, return_inverse=True)[1].astype(np.int64)
        above = np.full(n, -1)
        while len(waiting):
            # The first member of each waiting group becomes the node, the others its subtree.
            order = np.argsort(group, kind="stable")
            waiting, group, above = waiting[order], group[order], above[order]
            first = np.concatenate(([True], group[1:] != group[:-1]))
            node = waiting[first][np.cumsum(first) - 1]
            self.parent[waiting[first]] = above[first]
            known = above[first] >= 0
            self.edge[waiting[first][known]] = _distance(fp[waiting[first][known]], fp[above[first][known]])
            self.levels.append(waiting[first])
            rest = ~first
            self.root[waiting[rest]] = np.where(self.parent[node[rest]] < 0, node[rest], self.root[waiting[rest]])
            waiting, above = waiting[rest], node[rest]
            group = above * 65 + _distance(fp[waiting], fp[above])
        children = np.flatnonzero(self.parent >= 0)
        keys = self.parent[children] * 65 + self.edge[children]
        order = np.argsort(keys, kind="stable")
        self.child_keys, self.children = keys[order], children[order]

    def classes(self, radius: int, pairs_at_once: int = 1 << 20) -> np.ndarray:
        """Least member index of each member's class under links within the radius."""
        n = len(self.fp)
        links = Classes(n)
        # All members below an edge within the radius are that close to the node.
        near = np.full(n, -1)
        for level in self.levels[1:]:
            mother = self.parent[level]
            near[level] = np.where(self.edge[level] <= radius, mother, near[mother])
        # ... and a node's own near ancestor is linked in turn, so one link each is enough,
        # besides the link to the mother where that is the nearer one.
        linked = np.flatnonzero(near >= 0)
        links.join(linked, near[linked])
        label = links.labels()
        uniform = self._uniform(label)

        searcher = np.flatnonzero((self.parent >= 0) | self._has_child())
        for at in range(0, len(searcher), 1 << 16):
            q = searcher[at : at + (1 << 16)]
            stack = [(q, self.root[q])]
            while stack:
                q, node = stack.pop()
                if len(q) > pairs_at_once:
                    half = len(q) // 2
                    stack += [(q[:half], node[:half]), (q[half:], node[half:])]
                    continue
                open_ = ~(uniform[node] & (label[node] == label[q]))
                q, node = q[open_], node[open_]
                if not len(q):
                    continue
                d = _distance(self.fp[q], self.fp[node])
                hit = d <= radius
                links.join(q[hit], node[hit])
                low = np.searchsorted(self.child_keys, node * 65 + np.maximum(d - radius, 0), "left")
                high = np.searchsorted(self.child_keys, node * 65 + np.minimum(d + radius, 64), "right")
                count = high - low
                total = int(count.sum())
                if total:
                    offset = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
                    stack.append((np.repeat(q, count), self.children[np.repeat(low, count) + offset]))
            label = links.labels()
            uniform = self._uniform(label)
        return label

    def _has_child(self) -> np.ndarray:
        out = np.zeros(len(self.fp), bool)
        out[self.parent[self.parent >= 0]] = True
        return out

    def _uniform(self, label: np.ndarray) -> np.ndarray:
        """Whether the whole subtree of a node is in the node's class."""
        same = np.ones(len(self.fp), bool)
        for level in reversed(self.levels[1:]):
            bad = ~(same[level] & (label[level] == label[self.parent[level]]))
            same[self.parent[level[bad]]] = False
        return same


class Classes:
    """Union-find over array positions, joined and relabelled in bulk; labels are least members."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.label[a], self.label[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            self._flatten()

    def _flatten(self) -> None:
        while True:
            up = self.label[self.label]
            if (up == self.label).all():
                return
            self.label = up

    def labels(self) -> np.ndarray:
        return self.label.copy()


def _finer(mask: int, radius: int) -> list[int]:
    """``mask`` with two more blocks of its free bits: every pair of ``radius + 2`` blocks."""
    free = [b for b in range(64) if not mask >> b & 1]
    edges = [len(free) * i // (radius + 2) for i in range(radius + 3)]
    blocks = [sum(1 << b for b in free[x:y]) for x, y in zip(edges, edges[1:])]
    return [mask | x | y for x, y in combinations(blocks, 2)]


def shard_links(fps: DataFrame, radius: int = RADIUS, most: int = MOST_IN_TREE) -> DataFrame:
    """Links (a, b) that connect the vertices of fingerprints within the radius.

    ``fps``: fp (distinct), vertex.  Each fingerprint goes to one shard for every
    pair of bit blocks.  A shard counted above ``most`` is dealt again by pairs of
    blocks of the bits that it leaves free: its members within the radius
    agree on two of those blocks as well.  After a few levels so few bits are free
    that no shard can be larger.
    """
    signed = lambda m: m - (1 << 64) if m >= 1 << 63 else m
    rows, masks, out = fps.select("fp", "vertex", F.lit(0).cast("long").alias("mask")), {0}, None
    while True:
        # At most 15 masks on the first level, 225 on the second: a constant.
        finer = {str(m): [signed(f) for f in _finer(m % (1 << 64), radius)] for m in sorted(masks)}
        table = F.from_json(F.lit(json.dumps(finer)), "map<string,array<long>>")
        dealt = rows.withColumn("mask", F.explode(F.element_at(table, F.col("mask").cast("string"))))
        dealt = dealt.withColumn("bits", F.col("fp").bitwiseAND(F.col("mask")))
        # Two free bits a block: each level fixes more, and beneath it 2 ** (2 * radius + 3) are the most.
        crowded = dealt.groupBy("mask", "bits").count().filter((F.col("count") > most) & (F.bit_count("mask") <= 64 - 2 * (radius + 2)))
        crowded = settle(crowded.select("mask", "bits"))
        masks = {r.mask for r in crowded.select("mask").distinct().collect()}
        links = _tree_links(look_up(dealt, crowded, ["mask", "bits"], "left_anti") if masks else dealt, radius)
        out = out.union(links) if out is not None else links
        if not masks:
            return out
        rows = settle(look_up(dealt, crowded, ["mask", "bits"], "left_semi").select("fp", "vertex", "mask"))


def _tree_links(dealt: DataFrame, radius: int) -> DataFrame:
    """Links within the shards (mask, bits).  A task reads its shards one after the other,
    several at once, and holds no more than a batch beside the shard at hand."""
    dealt = dealt.select("mask", "bits", "fp", "vertex").repartition("mask", "bits").sortWithinPartitions("mask", "bits", "vertex")

    def link(mask, bits, fp, vertex) -> pa.RecordBatch:
        new = np.concatenate(([True], (mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])))
        shard = np.cumsum(new)
        crowded = np.bincount(shard)[shard] > 1
        shard, fp, vertex = shard[crowded], fp[crowded].view(np.uint64), vertex[crowded]
        a = b = np.empty(0, np.int64)
        if len(fp):
            label = Forest(shard, fp).classes(radius)
            moved = label != np.arange(len(label))
            a, b = vertex[moved], vertex[label[moved]]  # sorted by vertex within a shard: b < a
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "bits", "fp", "vertex")]
            # Rows of the last shard of a batch may go on in the next one.
            inside = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
            cut = int(inside[-1]) + 1 if len(inside) else 0
            if held and (cut or held[-1][0][-1] != now[0][0] or held[-1][1][-1] != now[1][0]):
                yield link(*[np.concatenate(x) for x in zip(*held, [c[:cut] for c in now])])
                held = []
            elif cut:
                yield link(*[c[:cut] for c in now])
            held.append([c[cut:] for c in now])
        if held:
            yield link(*[np.concatenate(x) for x in zip(*held)])

    return dealt.mapInArrow(search, "a long, b long")


# --- classes across shards --------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """vertex, root: the least vertex of each linked vertex's component.

    Alternating large-star and small-star rounds over the link table.  A star's
    least neighbour is a partial aggregate, and goes back to the links by a
    broadcast or salted join, so a vertex with very many links is not one task's work.
    """
    edges = settle(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        large = settle(_star(edges, large=True))
        small = settle(_star(large, large=False))
        before, after = (e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() for e in (edges, small))
        edges = small
        if before == after:
            return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root"))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round.  large: every larger neighbour of u links to the least of u and its neighbours;
    small: every smaller neighbour of u, and u, do."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        out = look_up(both, least, ["a"], "inner").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return out.filter("a <> b").distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    out = look_up(edges, least, ["a"], "inner").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def simhash_near_dedup(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per row of ``docs``."""
    prints = settle(fingerprints(docs, shingle_words))
    # Exact copies of a fingerprint collapse before any search: its vertex is its least doc_id.
    vertices = settle(prints.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("vertex")))
    # A doc_id under several fingerprints ties them together.
    several = prints.groupBy("doc_id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low <> high")
    repeats = look_up(prints, settle(several.select("doc_id")), ["doc_id"], "left_semi").distinct()
    ties = repeats.join(vertices, "fp").select(F.col("doc_id").alias("a"), F.col("vertex").alias("b"))
    roots = components(shard_links(vertices, radius).union(ties))
    labelled = vertices.join(roots, "vertex", "left").select("fp", F.coalesce("root", "vertex").alias("component"))
    out = prints.join(labelled, "fp", "left")
    return out.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"),
    )
