"""Packing: first-fit decreasing over a tournament tree of bin capacities.

Each document is tokenised whole and ends with id 1; it is cut every ``size``
tokens, so full pieces fill a sequence alone and one remainder per document is
left to place.  Pieces are counted and dealt into random groups of about
``GROUP_PIECES`` (by a hash of the piece and, where rows repeat, the number of
the copy, so neither long texts nor repeats make a group larger), and each
group is packed on its own in one task: pieces in order of falling length, each into the first sequence with
room, found by descending a tree that holds the largest free capacity below
each node.  Only lengths and checksums are shuffled unless ``keep_ids``.

Defined cases: a null text is empty and packs as the single id 1; rows that
repeat a ``doc_id`` are packed each on their own; ties in length go by
(doc_id, start, checksum), null ids first; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import islice
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import settle

SEQUENCE_TOKENS = 2048
END_ID = 1
GROUP_PIECES = 8192
COPIES = 4096  # of a repeated piece, that one step lists
# Bytes of a worker's table, an entry counted with what Python adds to it; longer words are not kept.
TABLE_BYTES, ENTRY_BYTES = 112 << 20, 170
LONGEST_KEPT = 64
CLOSING = b".,;:!?$%&*#"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


# The byte-level alphabet: printable Latin-1 characters stand for themselves, other bytes for 256 and up.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = sorted(set(range(256)).difference(_PRINTABLE))
_BYTE_LETTERS = {b: chr(256 + i) for i, b in enumerate(_OTHERS)}


def _plain_letters(part: bytes) -> str | None:
    """A word of lower-case Latin letters in the byte-level alphabet, which the merges take as it is."""
    if part.isalpha() and part.islower():
        return part.decode()
    if part.isascii():
        return None
    text = part.decode("utf-8", "replace")
    if text.isalpha() and text == text.lower() and max(text) < "\u0250" and is_normalized("NFC", text):
        return part.decode("latin-1").translate(_BYTE_LETTERS)
    return None


def _little_endian(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _stem_and_tail(word: bytes) -> tuple[bytes, bytes]:
    stem = word.rstrip(CLOSING)
    if len(stem) == len(word) or not stem.decode("utf-8", "replace")[-1:].lower()[-1:].isalpha():
        stem = word
    # Beyond ASCII, case folding and composition may not commute.
    return stem.lower() if stem.isascii() else stem, word[len(stem) :]


def _table_bytes(table: dict[bytes, bytes]) -> int:
    return sum(map(len, table)) + sum(map(len, table.values())) + ENTRY_BYTES * len(table)


class WordIds:
    """Token ids (little-endian uint32 bytes) of white-space separated words.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its words in turn.  It also splits a word between a letter and
    closing punctuation and folds case, so a new word is looked up as its
    lower-case stem and its closing marks, which are words too; only those never
    seen are encoded.  The table is bounded in bytes; when full, the half that
    came first stays, where frequent words are.
    """

    loaded: dict[str, "WordIds"] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.words: dict[bytes, bytes] = {b"": b""}
        self.held = 0

    @classmethod
    def of(cls, path: str) -> "WordIds":
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in cls.loaded:
            cls.loaded[path] = cls(path)
        return cls.loaded[path]

    def ids(self, text: bytes) -> bytes:
        words, known = text.split(), self.words
        new = set(words).difference(known)
        if new:
            fresh = self._learn(new)
            if not self._keep(fresh):
                return b"".join([fresh[w] if w in fresh else known[w] for w in words])
        return b"".join(map(known.__getitem__, words))

    def _keep(self, fresh: dict[bytes, bytes]) -> bool:
        """Put new words into the table; whether the table then holds them and all that it held before."""
        kept = fresh
        if max(map(len, fresh)) > LONGEST_KEPT:
            kept = {w: ids for w, ids in fresh.items() if len(w) <= LONGEST_KEPT}
        size = _table_bytes(kept)
        full = self.held + size > TABLE_BYTES
        if full:
            self.words = dict(islice(self.words.items(), 1 + len(self.words) // 2))
            self.held = _table_bytes(self.words)
        if self.held + size <= TABLE_BYTES:
            self.words.update(kept)
            self.held += size
        return kept is fresh and not full

    def _learn(self, new: set[bytes]) -> dict[bytes, bytes]:
        """The ids of ``new`` words, and of their stems and closing marks where the table lacks those."""
        known, marks = self.words, frozenset(CLOSING)
        split = [(w, *_stem_and_tail(w)) for w in new if w[-1] in marks or not w.islower()]
        # All other words are their own stems, and so are some of these.
        parts = new.difference([w for w, stem, _ in split if stem != w])
        parts.update([p for _, *own in split for p in own if p not in known])
        fresh, whole, merge = {}, [], self.model.model.tokenize
        for part in parts:
            letters = _plain_letters(part)
            if letters is None:
                whole.append(part)
            else:
                fresh[part] = _little_endian([t.id for t in merge(letters)])
        coded = self.model.encode_batch_fast([p.decode("utf-8", "replace") for p in whole], add_special_tokens=False)
        fresh.update((p, _little_endian(e.ids)) for p, e in zip(whole, coded))
        for word, stem, tail in split:
            if stem != word:
                fresh[word] = (fresh[stem] if stem in fresh else known[stem]) + (fresh[tail] if tail in fresh else known[tail])
        return fresh


def tokenize(docs: DataFrame, tokenizer: str, size: int = SEQUENCE_TOKENS, keep_ids: bool = False) -> DataFrame:
    """The pieces of every document: ``PIECES`` and, with ``keep_ids``, ids (array of int)."""
    end = np.asarray([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds.of(tokenizer)
        for batch in batches:
            rows: dict[str, list] = {name: [] for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                data = words.ids(text or b"") + end
                total = len(data) // 4
                for start in range(0, total, size):
                    piece = data[4 * start : 4 * (start + size)]
                    rows["doc_id"].append(doc_id)
                    rows["start"].append(start)
                    rows["length"].append(len(piece) // 4)
                    rows["ids_crc32"].append(zlib.crc32(piece))
                    rows["doc_tokens"].append(total)
                    if keep_ids:
                        rows["ids"].append(np.frombuffer(piece, "<i4"))
            columns = {k: pa.array(v, pa.int64()) for k, v in rows.items() if k != "ids"}
            if keep_ids:
                columns["ids"] = pa.array(rows["ids"], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)
        pa.default_memory_pool().release_unused()

    schema = PIECES + (", ids array<int>" if keep_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(cut, schema)


def first_fit(lengths: list[int], size: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item, in the given order, first fit over a tournament tree."""
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    free = [size] * (2 * leaves)  # free[1] is the root; leaf of bin b is leaves + b
    bins, offsets = [], []
    for need in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if free[node] < need:
                node += 1
        bins.append(node - leaves)
        offsets.append(size - free[node])
        free[node] -= need
        while node > 1:
            node //= 2
            left, right = free[2 * node], free[2 * node + 1]
            best = left if left >= right else right
            if free[node] == best:
                break
            free[node] = best
    return bins, offsets


def pack_pieces(pieces: DataFrame, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """Add sequence_id and offset to pieces, packing counted random groups apart."""
    counted = settle(pieces.groupBy(*pieces.columns).agg(F.count("*").alias("n_")))
    total = counted.agg(F.sum("n_")).first()[0] or 0
    groups = max(1, -(-total // GROUP_PIECES))
    # A piece comes back as often as it occurred, by steps, so no array of all its copies is made.
    steps = counted.withColumn("step_", F.explode(F.expr(f"sequence(0, (n_ - 1) div {COPIES})")))
    copies = F.expr(f"sequence(step_ * {COPIES}, least(n_, (step_ + 1) * {COPIES}) - 1)")
    every = steps.withColumn("copy_", F.explode(copies))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]
        table = table.sort_by(order).drop_columns(["group_"])
        bins, offsets = first_fit(table.column("length").to_pylist(), size)
        ids = np.asarray(bins, "i8") + (key[0].as_py() << 32)
        return table.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets, pa.int64()))

    group = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "copy_"), F.lit(groups)).cast("long")
    return every.withColumn("group_", group).select(*pieces.columns, "group_").groupBy("group_").applyInArrow(pack, schema)


def pack(docs: DataFrame, tokenizer: str, size: int = SEQUENCE_TOKENS, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place: PIECES (+ ids), sequence_id, offset."""
    return pack_pieces(tokenize(docs, tokenizer, size, keep_ids), size)
