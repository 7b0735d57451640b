"""Permutation index: approximate nearest neighbours by inner product.

A bounded sample of vectors are the pivots.  A vector is represented by its
``PREFIX`` nearest pivots in order.  Vectors are dealt into blocks by a hash of
their id; within a block, a pivot's inverted file lists the vectors that have
the pivot in their prefix, with its place there.  A query walks the files of
its own pivots and sums up the footrule distance (how far each pivot's place
differs, a pivot outside the prefix standing at its end); the nearest
``RERANKED`` share of a block by footrule is reranked by the exact inner
product in double precision, and the best of all blocks are merged.

Blocks and chunks of queries are bounded, so a task holds one block and one
chunk; the vectors are repeated once per chunk of queries and the queries once
per block.  Every vector is posted; only the pivots are a sample.

Defined cases: vectors that are null, zero or hold a null or non-finite
component take no part, nor do rows without an id, nor vectors of another
length than the most frequent (of equals, the smaller); rows that repeat a
``vec_id`` count once, with the least vector; ties in score go to the smaller
id; with fewer than ``k`` candidates all are returned; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import settle

NEAREST = 20
PIVOTS = 256  # the sample: 256 vectors, whatever the size of the table
PREFIX = 64
RERANKED = 0.15  # of a block, at least LEAST_RERANKED
LEAST_RERANKED = 400
BLOCK_VECTORS = 16_384
CHUNK_QUERIES = 4_096

FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id, vec (doubles) of the vectors that take part, one row per id."""
    vec = F.col(vector_column).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), vec.alias("vec"))
    rows = rows.filter(F.col("vec_id").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    rows = rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))
    rows = settle(rows)
    common = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("vec") == common[0]["n"]) if common else rows


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """The vectors whose ids hash lowest; at most ``pivots`` rows reach the driver."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("vec").collect()
    return np.array([r.vec for r in rows], np.float64)


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def prefixes(matrix: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each row, nearest first, ties by pivot number."""
    return np.argsort(-(matrix @ pivots.T), axis=1, kind="stable")[:, :prefix]


class Block:
    """Inverted files of one block: per pivot, the vectors that list it and its place there."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, pivots: np.ndarray, prefix: int):
        self.ids, self.matrix, self.pivots, self.prefix = ids, matrix, pivots, min(prefix, len(pivots))
        lists = prefixes(matrix, pivots, self.prefix)
        order = np.argsort(lists, axis=None, kind="stable")
        places = np.tile(np.arange(self.prefix, dtype=np.int32), len(ids))[order]
        members = np.repeat(np.arange(len(ids), dtype=np.int32), self.prefix)[order]
        bounds = np.searchsorted(lists.ravel()[order], np.arange(len(pivots) + 1))
        self.files = [(members[a:b], places[a:b]) for a, b in zip(bounds, bounds[1:])]

    def footrule(self, query: np.ndarray) -> np.ndarray:
        """Distance of the query's pivot order to that of every vector of the block.

        With all prefixes equally long, pivots outside both cancel out: the sum
        starts from two disjoint prefixes and each shared pivot corrects it.
        """
        end = self.prefix
        total = np.full(len(self.ids), end * (end + 1), np.int32)
        for place, pivot in enumerate(query):
            members, places = self.files[pivot]
            total[members] += np.abs(places - place) - (end - place) - (end - places)
        return total

    def nearest(self, query_id: int, vector: np.ndarray, order: np.ndarray, reranked: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        distance = self.footrule(order)
        most = min(len(self.ids), max(LEAST_RERANKED, k + 1, int(np.ceil(reranked * len(self.ids)))))
        near = np.argpartition(distance, most - 1)[:most] if most < len(distance) else np.arange(len(distance))
        near = near[self.ids[near] != query_id]
        score = (self.matrix[near] * vector).sum(axis=1)
        if len(score) > k:  # keep all that tie with the last
            floor = np.partition(score, len(score) - k)[len(score) - k]
            near, score = near[score >= floor], score[score >= floor]
        best = np.lexsort((self.ids[near], -score))[:k]
        return self.ids[near][best], score[best]


def search(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, pivots: int = PIVOTS, prefix: int = PREFIX, reranked: float = RERANKED) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each query, itself left out.

    ``vectors`` and ``queries``: vec_id, vec of one common length (see ``usable``).
    """
    chosen = choose_pivots(vectors, pivots)
    blocks = max(1, -(-vectors.count() // BLOCK_VECTORS))
    chunks = max(1, -(-queries.count() // CHUNK_QUERIES))

    def find(block: pa.Table, chunk: pa.Table) -> pa.Table:
        out = ([], [], [])
        if block.num_rows and chunk.num_rows:
            index = Block(block.column("vec_id").to_numpy(), _matrix(block.column("vec")), chosen, prefix)
            wanted = _matrix(chunk.column("vec"))
            orders = prefixes(wanted, chosen, index.prefix)
            for query_id, vector, order in zip(chunk.column("vec_id").to_pylist(), wanted, orders):
                ids, scores = index.nearest(query_id, vector, order, reranked, k)
                out[0].append(np.full(len(ids), query_id, np.int64))
                out[1].append(ids)
                out[2].append(scores)
        join = lambda parts, kind: pa.array(np.concatenate([np.empty(0, kind), *parts]))
        return pa.Table.from_arrays([join(out[0], np.int64), join(out[1], np.int64), join(out[2], np.float64)], names=["query_id", "vec_id", "score"])

    def dealt(n: int, salt: int):
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = vectors.select("vec_id", "vec", dealt(blocks, 1).alias("block"), every(chunks).alias("chunk"))
    right = queries.select("vec_id", "vec", dealt(chunks, 2).alias("chunk"), every(blocks).alias("block"))
    found = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(find, FOUND)
    # The best k of all blocks: at most k rows a block, merged per query.
    best = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), F.col("vec_id")))), 1, k).alias("best"))
    ranked = best.select("query_id", F.posexplode("best").alias("at", "b"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.minus")).alias("score"))
