"""Periodic run detection: maximal repetitions of words by suffix-tree LCE.

A run is a stretch of consecutive words with smallest period q, of length at
least ``max(least, 2 * q)``, that no neighbouring word extends keeping q.

Per stretch of words, two suffix trees are built by Ukkonen's algorithm, of the
stretch and of its reversal.  The Euler tour of a tree with range minima answers
the longest common extension of any two positions in constant time (the string
depth of the leaves' lowest common ancestor).  The leaves' order gives the next
smaller and next larger suffix of every position, which end the longest Lyndon
words from there in the order of symbols and in the inverse order.  Each run has
such a word as its root, so every Lyndon word is a candidate period and is
extended to the right by the first tree and to the left by the second.

Trees are built only where runs can be: of a run's first ``length - q`` words at
least six lie in a row, so its words are covered by six-word windows that occur
twice in the document.  Documents without such a window need no tree.

Documents are judged one by one, so the work is one pass without a shuffle; a
text and its trees must fit in a task's memory.

Defined cases: a null text has no words; equal rows give equal results; null ids
stay null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 12  # words of a run
BLOCK = 16  # tour places of a block of the range minima
QUERIES = 1 << 16  # extensions that are looked up at once

RUN = "struct<start:long,length:long,period:long>"
SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>, collapsed_text string"


class SuffixTree:
    """Ukkonen's tree of a list of symbols (integers from 1) and its end mark 0, with constant-time LCE."""

    def __init__(self, symbols: list[int]):
        s = [*symbols, 0]
        self.size = len(s)
        width = max(s) + 1
        begin, end, link, edges = self._build(s, width)
        self._tour(s, width, begin, end, edges)

    @staticmethod
    def _build(s: list[int], width: int) -> tuple[list[int], list[int], list[int], dict[int, int]]:
        """Edge labels s[begin:end] into each node, suffix links, and node * width + symbol -> child; 0 is the root."""
        n = len(s)
        begin, end, link = [0], [0], [0]
        edges: dict[int, int] = {}
        node = first = reach = open_ = 0  # the active point; suffixes still to be added
        for i, c in enumerate(s):
            fresh = 0  # the inner node that waits for its suffix link
            open_ += 1
            while open_:
                if not reach:
                    first = i
                key = node * width + s[first]
                below = edges.get(key)
                if below is None:
                    edges[key] = len(begin)
                    begin.append(i)
                    end.append(n)
                    link.append(0)
                    if fresh:
                        link[fresh] = node
                        fresh = 0
                else:
                    start = begin[below]
                    length = end[below] - start
                    if reach >= length:
                        first += length
                        reach -= length
                        node = below
                        continue
                    middle = start + reach
                    if s[middle] == c:
                        reach += 1
                        if fresh:
                            link[fresh] = node
                        break
                    split = len(begin)
                    begin += (start, i)
                    end += (middle, n)
                    link += (0, 0)
                    edges[key] = split
                    edges[split * width + c] = split + 1
                    begin[below] = middle
                    edges[split * width + s[middle]] = below
                    if fresh:
                        link[fresh] = split
                    fresh = split
                open_ -= 1
                if node:
                    node = link[node]
                elif reach:
                    reach -= 1
                    first = i - open_ + 1
        return begin, end, link, edges

    def _tour(self, s: list[int], width: int, begin: list[int], end: list[int], edges: dict[int, int]) -> None:
        """Euler tour of string depths; each suffix's place in it and its rank among suffixes."""
        n, nodes = len(s), len(begin)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        order = np.argsort(keys)
        child = np.fromiter(edges.values(), np.int64, len(edges))[order].tolist()
        offsets = np.searchsorted(keys[order], np.arange(nodes + 1, dtype=np.int64) * width).tolist()
        tour, leaves, places = [], [], []
        depth = [0] * nodes
        at = offsets[:nodes]  # the next child of each node
        stack = [0]
        while stack:
            node = stack[-1]
            tour.append(depth[node])
            i = at[node]
            if i < offsets[node + 1]:
                at[node] = i + 1
                below = child[i]
                depth[below] = depth[node] + end[below] - begin[below]
                stack.append(below)
            else:
                if offsets[node] == offsets[node + 1]:
                    leaves.append(n - depth[node])
                    places.append(len(tour) - 1)
                stack.pop()
        suffixes = np.array(leaves)
        self.rank = np.empty(n, np.int64)
        self.rank[suffixes] = np.arange(n)
        self.place = np.empty(n, np.int64)
        self.place[suffixes] = places
        self._minima(np.array(tour, np.int32))

    def _minima(self, depths: np.ndarray) -> None:
        """Minima from each place to either end of its block, and of 2**k blocks in a row."""
        blocks = -(-len(depths) // BLOCK)
        self.depths = np.full((blocks, BLOCK), np.iinfo(np.int32).max, np.int32)
        self.depths.ravel()[: len(depths)] = depths
        self.until = np.minimum.accumulate(self.depths, axis=1).ravel()
        self.since = np.ascontiguousarray(np.minimum.accumulate(self.depths[:, ::-1], axis=1)[:, ::-1]).ravel()
        self.depths = self.depths.ravel()
        self.powers = [self.until[BLOCK - 1 :: BLOCK]]
        while 2 ** len(self.powers) <= blocks:
            last, step = self.powers[-1], 2 ** (len(self.powers) - 1)
            self.powers.append(np.minimum(last[:-step], last[step:]))

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes i and j, which differ."""
        parts = [self._extension(i[k : k + QUERIES], j[k : k + QUERIES]) for k in range(0, len(i), QUERIES)]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    def _extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        x, y = self.place[i], self.place[j]
        low, high = np.minimum(x, y), np.maximum(x, y)
        out = np.minimum(self.since[low], self.until[high])
        a, b = low // BLOCK + 1, high // BLOCK  # whole blocks between: a .. b - 1
        level = np.frexp(np.maximum(b - a, 1).astype(np.float64))[1] - 1
        for k in np.unique(level[b > a]):
            of = (level == k) & (b > a)
            row = self.powers[k]
            out[of] = np.minimum(out[of], np.minimum(row[a[of]], row[b[of] - 2**k]))
        near = np.flatnonzero(a > b)  # both in one block: neither end's minimum is meant
        if len(near):
            at = low[near, None] + np.arange(BLOCK)
            inside = at <= high[near, None]
            values = np.where(inside, self.depths[np.minimum(at, len(self.depths) - 1)], np.iinfo(np.int32).max)
            out[near] = values.min(axis=1)
        return out.astype(np.int64)


def _next_below(values: list[int]) -> list[int]:
    """For each place the next one with a smaller value, or -1."""
    out, stack = [-1] * len(values), []
    for i, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            out[stack.pop()] = i
        stack.append(i)
    return out


def runs_of(symbols: list[int], least: int = LEAST) -> np.ndarray:
    """(start, length, period) of all runs of a list of symbols (integers from 1), by start and period."""
    n = len(symbols)
    forward, backward = SuffixTree(symbols), SuffixTree(symbols[::-1])
    ranks = forward.rank[:n]
    ends = np.concatenate([_next_below(x) for x in (ranks.tolist(), (-ranks).tolist())])
    start = np.tile(np.arange(n), 2)[ends >= 0]
    after = ends[ends >= 0]
    period = after - start
    stop = after + forward.extension(start, after)
    begin = start.copy()
    inner = start > 0
    # A suffix of the reversal that starts at n - i reads the words before i backwards.
    begin[inner] -= backward.extension(n - start[inner], n - after[inner])
    length = stop - begin
    found = length >= np.maximum(least, 2 * period)
    return np.unique(np.stack([begin[found], period[found], length[found]], axis=1), axis=0)[:, [0, 2, 1]]


def stretches(symbols: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Parts [start, stop) that hold every run: covered by windows of ``least // 2`` words that occur twice."""
    window = max(1, least // 2)
    n = len(symbols) - window + 1
    if len(symbols) < least:
        return []
    mixed = (symbols.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    keys = mixed[:n].copy()
    for i in range(1, window):
        keys *= np.uint64(0xD1342543DE82EF95)
        keys += mixed[i : i + n]
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return []
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    cuts = np.flatnonzero(at[1:] > at[:-1] + window)
    starts, stops = at[np.concatenate(([0], cuts + 1))], at[np.concatenate((cuts, [len(at) - 1]))] + window
    return [(a, b) for a, b in zip(starts.tolist(), stops.tolist()) if b - a >= least]


def runs_of_words(words: list[bytes], least: int = LEAST) -> np.ndarray:
    """(start, length, period) of all runs of a list of words, by start and period."""
    if len(words) < least:
        return np.empty((0, 3), np.int64)
    known: dict[bytes, int] = {}
    symbols = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    found = []
    for start, stop in stretches(symbols, least):
        own = np.unique(symbols[start:stop], return_inverse=True)[1] + 1
        runs = runs_of(own.tolist(), least)
        runs[:, 0] += start
        found.append(runs)
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def split_words(doc_id: int | None, text: bytes | None) -> list[bytes]:
    return (text or b"").split()


def planted_words(doc_id: int | None, text: bytes | None) -> list[bytes]:
    """The words, a tenth of the documents (by crc32 of the id) made periodic from some word on."""
    words = (text or b"").split()
    if doc_id is None or not words:
        return words
    g, chosen = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if not chosen:
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        root = words[a : a + p]
        words = words[:a] + (root * (-(-(len(words) - a) // p)))[: len(words) - a]
    return words


def periodic_runs(
    docs: DataFrame, least: int = LEAST, words_of: Callable[[int | None, bytes | None], list[bytes]] = split_words
) -> DataFrame:
    """doc_id, n_words, runs (by start, then period), collapsed_text: the words that no run repeats.

    A word that a run contains after its first period is dropped; the others are joined by one space.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, texts, counts, runs = batch.column("doc_id").to_pylist(), [], [], [], []
            for doc_id, text in zip(ids, batch.column("text").to_pylist()):
                words = words_of(doc_id, text)
                found = runs_of_words(words, least)
                sizes.append(len(words))
                counts.append(len(found))
                if len(found):
                    runs.append(found)
                    steps = np.zeros(len(words) + 1, np.int64)
                    np.add.at(steps, found[:, 0] + found[:, 2], 1)
                    np.add.at(steps, found[:, 0] + found[:, 1], -1)
                    words = [w for w, n in zip(words, np.cumsum(steps).tolist()) if not n]
                texts.append(b" ".join(words))
            every = np.concatenate(runs) if runs else np.empty((0, 3), np.int64)
            items = pa.StructArray.from_arrays([pa.array(every[:, k], pa.int64()) for k in range(3)], ["start", "length", "period"])
            offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, items), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed_text"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(scan, SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest one, and hashes of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    every = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("top", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.before")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.shorter")).alias("period"),
        F.expr("(1000 * top.length) div (-top.shorter)").alias("exponent_milli"),
        F.sha2(every, 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )
