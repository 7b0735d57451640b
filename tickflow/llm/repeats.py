"""Keys of word sequences that occur in more than one document.

Shared by substring dedup and suffix-array dedup: words hashed through a
bounded per-worker table, polynomial (Rabin-Karp) hashes of word windows in
numpy, and one shuffle that finds the keys held by several documents.

A task first settles what it can on its own: of the documents of a chunk that
hold a key, only the least is sent on, so a window that occurs in a third of
all documents costs one entry per chunk.  Entries travel packed (one row per
chunk and bucket, arrays of hashes and document ids); the bucket comes from
one hash and the key within it from a second, independent one.  A bucket sorts
its keys and compares neighbours; what it finds travels packed as well, one row
per bucket and home of documents, and each home hands out one row per document.
Buckets and homes hold a bounded share of the text, so their number grows with
the data and no group does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_ID = (1 << 63) - 1  # stands for a null doc_id: after all others
CHUNK_WORDS = 1 << 20
BUCKET_BYTES = 16 << 20
VOCABULARY = 1 << 19
BASE_A, BASE_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
MIX = np.uint64(0xFF51AFD7ED558CCD)


class Words:
    """Two 64-bit hashes per distinct word, kept in arrays; emptied when full."""

    one: "Words | None" = None

    def __init__(self):
        self.clear()

    @classmethod
    def get(cls) -> "Words":
        cls.one = cls.one or cls()
        return cls.one

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.hashes = np.empty((1 << 12, 2), np.uint64)

    def of(self, words: list[bytes]) -> np.ndarray:
        """(n, 2) hashes of the words."""
        new = set(words).difference(self.place)
        if len(self.place) + len(new) > VOCABULARY and self.place:
            self.clear()
            new = set(words)
        if new:
            at, full = len(self.place), len(self.place) + len(new)
            if full > len(self.hashes):
                grown = np.empty((max(full, 2 * len(self.hashes)), 2), np.uint64)
                grown[:at] = self.hashes[:at]
                self.hashes = grown
            fresh = b"".join(map(xxhash.xxh3_128_digest, new))
            self.place.update(zip(new, range(at, full)))
            self.hashes[at:full] = np.frombuffer(fresh, ">u8").reshape(-1, 2)
        return self.hashes[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))]


def polynomial(hashes: np.ndarray, base: np.uint64, length: int, mixed: bool = True) -> np.ndarray:
    """Rabin-Karp hash (mod 2**64) of every run of ``length`` words, by start."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, length):
        out *= base
        out += hashes[i : i + n]
    return (out ^ (out >> np.uint64(29))) * MIX if mixed else out


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))) if len(sorted_keys) else np.empty(0, np.int64)


def _lists(groups: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, pa.ListArray]:
    """Values gathered by group (both unsorted): group of each list, the lists."""
    order = np.argsort(groups, kind="stable")
    groups, values = groups[order], values[order]
    starts = _runs(groups)
    offsets = np.concatenate((starts, [len(groups)])).astype(np.int32)
    return groups[starts], pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def bucket_count(docs: DataFrame) -> int:
    """Buckets of about ``BUCKET_BYTES`` of text each, at least one per shuffle partition."""
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))


PACKED = "kind int, place long, docs array<long>, counts array<int>, hashes array<long>"
WANTED, OFFERED, FOUND, NOTE = range(4)  # kinds of packed rows


class Entry(NamedTuple):
    """Keys of one row: bucket hashes and key hashes (uint64).

    ``wanted`` marks the keys whose repetition the document asks for (None: all);
    the others are only offered to documents that ask.  ``note`` (int64) is
    delivered with the answer.
    """

    doc_id: int | None
    a: np.ndarray
    b: np.ndarray
    wanted: np.ndarray | None = None
    note: np.ndarray | None = None


Keys = Iterator[Entry]


def _pack(place: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """Per place: its documents (differences of rising ids), the number of keys of each, their keys."""
    order = np.lexsort((ids, place))
    place, ids, keys = place[order], ids[order], keys[order]
    new = np.concatenate(([True], (place[1:] != place[:-1]) | (ids[1:] != ids[:-1])))
    at = np.flatnonzero(new)
    counts = np.diff(np.concatenate((at, [len(ids)]))).astype(np.int32)
    docs, of = ids[at], place[at]
    same = np.concatenate(([False], of[1:] == of[:-1]))
    steps = np.where(same, docs - np.concatenate(([0], docs[:-1])), docs)
    places, hashes = _lists(place, keys)
    return places, [_lists(of, steps)[1], _lists(of, counts)[1], hashes]


def _unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Document and key of every entry of packed rows."""
    ids, keys = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for batch in table.to_batches():
        docs, counts, hashes = (batch.column(c) for c in ("docs", "counts", "hashes"))
        for i in range(batch.num_rows):
            ids.append(np.repeat(np.cumsum(docs[i].values.to_numpy()), counts[i].values.to_numpy()))
        keys.append(hashes.flatten().to_numpy(zero_copy_only=False))
    return np.concatenate(ids), np.concatenate(keys)


def repeated_keys(
    rows: DataFrame,
    keys_of: Callable[[pa.RecordBatch], Keys],
    buckets: int,
    first_too: bool,
    answer: Callable[[np.ndarray, np.ndarray, Iterator[tuple[int, np.ndarray]]], pa.Table] | None = None,
    schema: str = "doc_id long, hashes array<long>",
) -> DataFrame:
    """doc_id, hashes: per document the wanted keys that a document with a smaller id holds too.

    ``keys_of(batch)`` gives the entries of a batch of ``rows``.  With ``first_too`` the
    smallest document that holds a repeated key has it as well.  Null ids are ``NO_ID``.
    ``answer(ids, keys, notes)`` may turn a home's found keys and its documents' notes
    into rows of ``schema`` instead.
    """

    def spread(hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)

    def home(ids: np.ndarray) -> np.ndarray:
        return spread((ids.view(np.uint64) ^ (ids.view(np.uint64) >> np.uint64(31))) * MIX)

    def rows_of(kind: int, place: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(ids):
            places, lists = _pack(place, ids, keys)
            for i in range(0, len(places), 256):
                part = slice(i, i + 256)
                columns = [pa.array(np.full(len(places[part]), kind, np.int32)), pa.array(places[part]), *[x[part] for x in lists]]
                yield pa.RecordBatch.from_arrays(columns, schema=packed)

    def send(ids: np.ndarray, a: np.ndarray, b: np.ndarray, wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(b)
        ids, a, b, wanted = ids[order], a[order], b[order].view(np.int64), wanted[order]
        starts = _runs(b)
        least, several, repeats = compare(ids, starts)
        found = repeats & wanted
        yield from rows_of(FOUND, home(ids[found]), ids[found], b[found])  # known here already
        sizes = np.diff(np.concatenate((starts, [len(ids)])))
        asks = np.logical_or.reduceat(wanted & (ids == np.repeat(least, sizes)), starts)
        if first_too:
            asks &= ~several
        for kind, part in ((WANTED, starts[asks]), (OFFERED, starts[~asks])):
            yield from rows_of(kind, spread(a[part]), least[asks if kind == WANTED else ~asks], b[part])

    def compare(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of entries sorted by key: least document of each key, keys of several documents, entries that repeat."""
        least, most = np.minimum.reduceat(ids, starts), np.maximum.reduceat(ids, starts)
        sizes = np.diff(np.concatenate((starts, [len(ids)])))
        repeats = np.repeat(least != most, sizes)
        return least, least != most, repeats if first_too else repeats & (ids != np.repeat(least, sizes))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            for entry in keys_of(batch):
                doc_id, n = NO_ID if entry.doc_id is None else entry.doc_id, len(entry.b)
                if n:
                    wanted = np.ones(n, bool) if entry.wanted is None else entry.wanted
                    held.append((np.full(n, doc_id, np.int64), entry.a, entry.b, wanted))
                    size += n
                if entry.note is not None:
                    one = np.full(len(entry.note), doc_id, np.int64)
                    places = pa.array(home(one[:1]))
                    lists = [pa.array([x], pa.list_(kind)) for x, kind in ((one[:1], pa.int64()), ([len(one)], pa.int32()), (entry.note, pa.int64()))]
                    yield pa.RecordBatch.from_arrays([pa.array([NOTE], pa.int32()), places, *lists], schema=packed)
                if size > CHUNK_WORDS:
                    yield from send(*map(np.concatenate, zip(*held)))
                    held, size = [], 0
        if held:
            yield from send(*map(np.concatenate, zip(*held)))

    packed = pa.schema([("kind", pa.int32()), ("place", pa.int64()), ("docs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("hashes", pa.list_(pa.int64()))])

    def find(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        table = table.select(packed.names).cast(packed)
        ids, keys = _unpack(table.filter(pa.array(kinds == WANTED)))
        more, others = _unpack(table.filter(pa.array(kinds == OFFERED)))
        wanted = np.arange(len(ids) + len(more)) < len(ids)
        ids, keys = np.concatenate((ids, more)), np.concatenate((keys, others))
        out = table.filter(pa.array(kinds >= FOUND))
        if len(keys):
            order = np.argsort(keys)
            ids, keys, wanted = ids[order], keys[order], wanted[order]
            found = compare(ids, _runs(keys))[2] & wanted
            out = pa.concat_tables([out, pa.Table.from_batches(rows_of(FOUND, home(ids[found]), ids[found], keys[found]), schema=packed)])
        return out

    def hand_out(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        ids, keys = _unpack(table.filter(pa.array(kinds == FOUND)))
        if answer is None:
            docs, lists = _lists(ids, keys)
            return pa.Table.from_arrays([pa.array(docs), lists], names=["doc_id", "hashes"])
        notes = table.filter(pa.array(kinds == NOTE))
        pairs = zip(notes.column("docs").combine_chunks().flatten().to_pylist(), notes.column("hashes"))
        return answer(ids, keys, ((doc_id, note.values.to_numpy()) for doc_id, note in pairs))

    found = rows.mapInArrow(read, PACKED).groupBy("place").applyInArrow(find, PACKED)
    return found.groupBy("place").applyInArrow(hand_out, schema)


def texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def keys_of_texts(keys: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]) -> Callable[[pa.RecordBatch], Keys]:
    def read(batch: pa.RecordBatch) -> Keys:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            yield Entry(doc_id, *keys((text or b"").split()))

    return read


def with_keys(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (doc_id, ...) with the repeated keys of their id, null where there is none."""
    own = found.withColumnRenamed("doc_id", "id_")
    return rows.join(own, F.coalesce("doc_id", F.lit(NO_ID)) == F.col("id_"), "left").drop("id_")


def merged(starts: np.ndarray, stops: np.ndarray, gap: int = 0) -> list[tuple[int, int]]:
    """Maximal intervals of the union of [start, stop)."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.concatenate(([True], starts[1:] > stops[:-1] + gap))
    last = np.concatenate((new[1:], [True]))
    return list(zip(starts[new].tolist(), stops[last].tolist()))
