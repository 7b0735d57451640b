"""Line dedup: two Bloom filters find suspected repeats, exact counts confirm them.

A text is split at ``\\n`` (null or empty: one empty line).  A line's key is the
line stripped of ASCII white space at both ends with A-Z lower-cased.  A key of
at least ``LEAST`` code points that two documents hold is repeated: it stays in
the document with the smallest id and every other document loses all its lines.

The key hashes are dealt to shards by their high bits.  A shard keeps two Bloom
filters: keys seen once, and keys seen again in another chunk of documents.
Only holders of keys in the second filter go on, as suspects, to an exact count
of documents per 128-bit key digest, which also names the first of them.  The
filters lose no repeat, and what they suspect wrongly the count clears.

Shards take a bounded share of the text, so their number grows with the data.
A chunk sends a key that several of its documents hold only once, so a line in
a third of all documents costs its shard one entry per chunk; its holders are
suspects at once and are spread by row.  Line texts never move; documents are
shuffled once, to meet the keys that they lose.

Defined cases: rows that share a ``doc_id`` are one document; null ids are one
document, larger than any other; equal rows give equal results; a text whose
lines all go becomes empty; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import look_up, settle

LEAST = 10  # code points of a key
CHUNK_LINES = 1 << 18
SHARD_BYTES = 16 << 20  # of text
SPACE = b" \t\n\x0b\x0c\r"
NO_ID = (1 << 63) - 1  # stands for a null doc_id: after all others

BITS_PER_KEY = 16
PROBES = 4

SUSPECT, ONCE, SEVERAL = range(3)
PACKED = "kind int, place int, digests binary, docs binary, rows binary"
SUSPECTS = "`row` long, doc long, a long, b long"


class Bloom:
    """A Bloom filter over 64-bit hashes, a byte per bit."""

    def __init__(self, keys: int):
        self.mask = np.uint64((1 << max(10, (max(1, keys) * BITS_PER_KEY - 1).bit_length())) - 1)
        self.bits = np.zeros(int(self.mask) + 1, bool)

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        step = (hashes >> np.uint64(17)) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
        for i in range(PROBES):
            yield ((hashes + np.uint64(i) * step) >> np.uint64(7)) & self.mask

    def add(self, hashes: np.ndarray) -> None:
        for at in self._places(hashes):
            self.bits[at] = True

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for at in self._places(hashes):
            out &= self.bits[at]
        return out


def line_keys(text: bytes | None, least: int) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text and the key of each, None where it is shorter than ``least`` code points."""
    lines = (text or b"").split(b"\n")
    keys: list[bytes | None] = []
    for line in lines:
        key = line.strip(SPACE).lower()
        long = len(key) >= 4 * least or len(key) >= least and len(key.decode()) >= least
        keys.append(key if long else None)
    return lines, keys


def _digests(keys: list[bytes]) -> np.ndarray:
    """(n, 2) unsigned 64-bit halves of the keys' XXH3 128-bit digests."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), ">u8").astype(np.uint64).reshape(-1, 2)


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``row``, a hash of both: rows that share it are equal."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.col("text").cast("binary").alias("text"), F.xxhash64(doc_id, "text").alias("row"))


def shard_count(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> int:
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_bytes))


def suspects(rows: DataFrame, shards: int, least: int = LEAST) -> DataFrame:
    """row, doc, a, b: who holds a key that the filters take for repeated (its digest's halves)."""

    def place(hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)

    def pack(kind: int, at: np.ndarray, *values: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(at):
            return
        order = np.argsort(at, kind="stable")
        at, values = at[order], [v[order] for v in values]
        starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        stops = np.concatenate((starts[1:], [len(at)]))
        columns = [[v[i:j].tobytes() for i, j in zip(starts, stops)] for v in values]
        columns += [[None] * len(starts)] * (3 - len(columns))
        yield pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(starts), pa.int32()), pa.array(at[starts], pa.int32()), *[pa.array(c, pa.binary()) for c in columns]],
            names=["kind", "place", "digests", "docs", "rows"],
        )

    def send(digests: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((marks, ids, digests[:, 1], digests[:, 0]))
        digests, ids, marks = digests[order], ids[order], marks[order]
        same = (digests[1:] == digests[:-1]).all(axis=1)
        again = np.concatenate(([False], same & (ids[1:] == ids[:-1]) & (marks[1:] == marks[:-1])))  # a line repeated in its document
        digests, ids, marks = digests[~again], ids[~again], marks[~again]
        starts = np.flatnonzero(np.concatenate(([True], (digests[1:] != digests[:-1]).any(axis=1))))
        several = np.minimum.reduceat(ids, starts) != np.maximum.reduceat(ids, starts)
        held = np.repeat(several, np.diff(np.concatenate((starts, [len(ids)]))))
        spread = place(marks.view(np.uint64) * np.uint64(0xD1342543DE82EF95))
        yield from pack(SUSPECT, spread[held], digests[held], ids[held], marks[held])  # known here already
        yield from pack(SEVERAL, place(digests[starts[several], 0]), digests[starts[several]])
        yield from pack(ONCE, place(digests[~held, 0]), digests[~held], ids[~held], marks[~held])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, ids, marks, size = [], [], [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "text", "row")]
            for doc_id, text, row in zip(*columns):
                keys = [k for k in line_keys(text, least)[1] if k is not None]
                if keys:
                    digests.append(_digests(keys))
                    ids.append(np.full(len(keys), NO_ID if doc_id is None else doc_id, np.int64))
                    marks.append(np.full(len(keys), row, np.int64))
                    size += len(keys)
                if size >= CHUNK_LINES:
                    yield from send(*map(np.concatenate, (digests, ids, marks)))
                    digests, ids, marks, size = [], [], [], 0
        if size:
            yield from send(*map(np.concatenate, (digests, ids, marks)))

    def find(table: pa.Table) -> pa.Table:
        kinds, packed = table.column("kind").to_pylist(), table.column("digests").to_pylist()
        digests = [np.frombuffer(x, np.uint64).reshape(-1, 2) for x in packed]
        total = sum(len(d) for d, kind in zip(digests, kinds) if kind != SUSPECT)
        once, twice = Bloom(total), Bloom(total)
        for own, kind in zip(digests, kinds):
            if kind == SEVERAL:
                twice.add(own[:, 0])
            if kind == ONCE:
                twice.add(own[once.has(own[:, 0]), 0])
            if kind != SUSPECT:
                once.add(own[:, 0])
        out: list[list[np.ndarray]] = [[], [], [], []]
        for own, kind, docs, marks in zip(digests, kinds, table.column("docs"), table.column("rows")):
            if kind == SEVERAL:
                continue
            hit = slice(None) if kind == SUSPECT else twice.has(own[:, 0])
            ids, at = (np.frombuffer(x.as_py(), np.int64) for x in (docs, marks))
            for column, values in zip(out, (at, ids, own[:, 0].view(np.int64), own[:, 1].view(np.int64))):
                column.append(values[hit])
        columns = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64), pa.int64()) for c in out]
        return pa.Table.from_arrays(columns, names=["row", "doc", "a", "b"])

    return rows.mapInArrow(read, PACKED).repartition(shards, "place").groupBy("place").applyInArrow(find, SUSPECTS)


def remove_repeated_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text (the lines that stay, joined by ``\\n``)."""
    rows = _rows(docs)
    held = settle(suspects(rows, shard_count(docs), least))
    counted = held.groupBy("a", "b").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    repeated = settle(counted.filter("first < last").select("a", "b", "first"))
    lost = look_up(held, repeated, ["a", "b"], "inner").filter("doc > first")
    lost = lost.groupBy("row").agg(F.collect_list("a").alias("lost_a"), F.collect_list("b").alias("lost_b"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"doc_id": batch.column("doc_id").to_pylist(), "n_lines": [], "n_dropped": [], "kept_text": []}
            halves = [batch.column(c) for c in ("lost_a", "lost_b")]
            for i, text in enumerate(batch.column("text").to_pylist()):
                text = text or b""
                if not halves[0][i].is_valid:
                    n_lines, kept = text.count(b"\n") + 1, None
                else:
                    lines, keys = line_keys(text, least)
                    gone = set(zip(*(half[i].values.to_numpy().view(np.uint64).tolist() for half in halves)))
                    own = iter(map(tuple, _digests([k for k in keys if k is not None]).tolist()))
                    kept = [line for line, key in zip(lines, keys) if key is None or next(own) not in gone]
                    n_lines, text = len(lines), b"\n".join(kept)
                out["n_lines"].append(n_lines)
                out["n_dropped"].append(0 if kept is None else n_lines - len(kept))
                out["kept_text"].append(text)
            kinds = {"doc_id": pa.int64(), "n_lines": pa.int64(), "n_dropped": pa.int64(), "kept_text": pa.binary()}
            arrays = [pa.array(out[c], kind) for c, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays([*arrays[:3], arrays[3].cast(pa.string())], names=list(kinds))

    return rows.join(lost, "row", "left").mapInArrow(cut, "doc_id long, n_lines long, n_dropped long, kept_text string")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of ``remove_repeated_lines``."""
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = f"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line),
judged AS (
  SELECT *, CASE WHEN length(key) >= {LEAST} AND min(doc_id) OVER (PARTITION BY key) < doc_id THEN 1 ELSE 0 END AS gone
  FROM keyed)
SELECT doc_id, count(*) AS n_lines, sum(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE gone = 0), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""
