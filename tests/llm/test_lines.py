import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from awkward import awkward_rows, documents

from tickflow.llm import lines
from tickflow.llm.lines import Bloom, digest, remove_repeated_lines, suspects

SPACE = b" \t\n\x0b\x0c\r"


def brute(rows, least=10):
    order = lambda i: lines.NO_ID if i is None else i
    holders = defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders[line.encode().strip(SPACE).lower()].add(order(doc_id))
    out = Counter()
    for doc_id, text, *_ in rows:
        own = (text or "").split("\n")
        kept = []
        for line in own:
            key = line.encode().strip(SPACE).lower()
            if len(key.decode()) < least or min(holders[key]) == order(doc_id):
                kept.append(line)
        out[doc_id, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    return out


def line_rows():
    hot = "All rights reserved by the house"
    rows = [(i, f"{hot}\nown line number {i}\n\n{hot.upper()} \t\nshort\nshort\n éééééééé9") for i in range(30)]
    rows += [(i, f"  {hot}\x0b") for i in range(40, 60)] + [(None, f"{hot}\nno id holds this\n") for _ in range(20)]
    rows += [(70, "éééééééé90\nabcdefghij\n\xa0abcdefghij"), (71, "ÉÉÉÉÉÉÉÉ90\nABCDEFGHIJ\n\xa0ABCDEFGHIJ"), (72, "éééééééé90\nabcdefghi")]
    rows += [(80, "twice in one document\ntwice in one document"), (81, "\n" * 50), (82, "x" * 500_000 + "\n" + "a long line " * 9000)]
    rows += [(83, "a long line " * 9000), (70, "under a repeated id\nabcdefghij"), (90, "under a repeated id")]
    return rows + [rows[3], rows[3], (-4, rows[5][1])]


@pytest.mark.parametrize("chunk, shard", [(1 << 18, 16 << 20), (7, 200)])
@pytest.mark.parametrize("rows", [line_rows(), awkward_rows(), []], ids=["lines", "awkward", "empty"])
def test_lines_match_brute_force(spark, monkeypatch, rows, chunk, shard):
    monkeypatch.setattr(lines, "CHUNK_LINES", chunk)
    monkeypatch.setattr(lines, "shard_count", lambda docs: max(2, 2000 // shard))
    out = digest(remove_repeated_lines(documents(spark, rows).repartition(4))).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in out) == brute(rows)


def test_a_hot_line_costs_its_shard_one_entry_a_chunk(spark):
    rows = [(i, f"the same line everywhere\nown line {i:09d}") for i in range(3000)]
    found = suspects(lines._rows(documents(spark, rows).repartition(3)), 8).collect()
    hot = Counter((r.a, r.b) for r in found).most_common(1)[0]
    assert hot[1] == 3000  # all holders are suspects
    assert len(found) < 3000 + 30  # and next to none else is


def test_filters_lose_nothing():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    table = Bloom(len(keys))
    table.add(keys[:10_000])
    assert table.has(keys[:10_000]).all()
    assert table.has(keys[10_000:]).mean() < 0.01
