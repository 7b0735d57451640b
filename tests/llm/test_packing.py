import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from awkward import awkward_rows, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickflow.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_ids(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1]


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=[chr(c) for c in range(0x20, 0x250)], max_size=30) | st.text(alphabet=st.characters(codec="utf-8"), max_size=60) | st.text(alphabet="aAé'́ \t\n  \x1c\x85st0-<|endoftext|>İΣ.,!$H̱", max_size=40))
def test_word_ids_equal_text_ids(text):
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.WordIds.of(PATH).ids(text.encode()), "<u4").tolist() == want


def brute_first_fit(lengths, size):
    free, bins, offsets = [], [], []
    for need in lengths:
        at = next((i for i, f in enumerate(free) if f >= need), None)
        if at is None:
            at = len(free)
            free.append(size)
        bins.append(at)
        offsets.append(size - free[at])
        free[at] -= need
    return bins, offsets


@given(st.lists(st.integers(1, 32), max_size=60))
def test_tree_is_first_fit(lengths):
    lengths.sort(reverse=True)
    assert packing.first_fit(lengths, 32) == brute_first_fit(lengths, 32)


@pytest.mark.parametrize("group_pieces", [8192, 5])
def test_round_trip(spark, monkeypatch, group_pieces):
    monkeypatch.setattr(packing, "GROUP_PIECES", group_pieces)
    monkeypatch.setattr(packing, "TABLE_BYTES", 100_000)
    rows = [r for r in awkward_rows() if r[0] is not None]
    rows = [(i, r[1]) for i, r in enumerate(rows)]
    out = packing.pack(documents(spark, rows), PATH, keep_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in out:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.asarray(r.ids, "<u4").tobytes())
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, text in rows:
        pieces, want = sorted(by_doc[i], key=lambda r: r.start), brute_ids(text)
        assert [x for p in pieces for x in p.ids] == want
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        assert all(p.doc_tokens == len(want) for p in pieces)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        assert sum(p.length for p in pieces) <= 2048
    plain = packing.pack(documents(spark, rows).repartition(3), PATH).collect()
    assert sorted(map(tuple, plain)) == sorted(tuple(r)[:5] + tuple(r)[6:] for r in out)


def test_reruns_agree_and_padding_is_little(spark):
    from tickflow.llm.common import load

    docs = load(spark, "/root/testdata/sf0.01", "documents")
    a = packing.pack(docs, PATH).collect()
    b = packing.pack(docs.repartition(7), PATH).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    tokens, sequences = sum(r.length for r in a), len({r.sequence_id for r in a})
    assert tokens / (2048 * sequences) > 0.97


def test_repeated_null_and_empty(spark):
    rows = awkward_rows()
    out = packing.pack(documents(spark, rows), PATH).collect()
    assert sum(r.start == 0 for r in out) == len(rows)
    assert packing.pack(documents(spark, []), PATH).count() == 0
    (only,) = packing.pack(documents(spark, [(7, None)]), PATH).collect()
    assert (only.length, only.doc_tokens, only.offset) == (1, 1, 0)


def test_long_texts_and_repeats_make_no_large_group(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 50)
    monkeypatch.setattr(packing, "COPIES", 7)
    rows = [(1, "alpha beta gamma delta " * 500), *[(None, "the same text")] * 300, *((i, f"word {i}") for i in range(2, 200))]
    out = packing.pack(documents(spark, rows), PATH, size=16).collect()
    assert sum(r.start == 0 for r in out) == len(rows)
    groups = Counter(r.sequence_id >> 32 for r in out)
    assert len(groups) == -(-len(out) // 50) and max(groups.values()) < 100
    assert Counter((r.sequence_id, r.offset) for r in out).most_common(1)[0][1] == 1
