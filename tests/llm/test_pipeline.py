"""The corpus pipeline against plain Python, stage by stage."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from awkward import awkward_rows, documents
from test_exact_mixing import _targets
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tickflow.llm.common import load

NAMES = ["language_id", "exact_dedup", "simhash_near_dedup", "mixing", "packing"]
BLANK = re.compile(r"[\x20\x09-\x0D]+")


def _near(rows):
    ids = {r[0] for r in rows if r[0] is not None}
    component = brute_components([(r[0], brute_fingerprint(r[1])) for r in rows if r[0] is not None])
    gone = {i for i in ids if component[i] != i}
    return [r for r in rows if r[0] is None or r[0] not in gone]


def _exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[BLANK.sub(" ", r[1] or "")].append(r)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]


def _mix(rows):
    size = lambda t: len((t or "").encode().split())
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size(r[1])
    out = []
    for source, target in _targets(dict(sizes)).items():
        if not sizes[source]:
            continue
        epochs, left = divmod(int(target), sizes[source])
        key = lambda r: (hashlib.md5(f"mix:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] or 0)
        for r in sorted((r for r in rows if r[3] == source), key=key):
            taken = min(size(r[1]), left)
            left -= taken
            out += [r] * (epochs if size(r[1]) else 0)
            if 0 < taken == size(r[1]):
                out.append(r)
            elif taken:
                out.append((r[0], b" ".join(r[1].encode().split()[:taken]).decode(), *r[2:]))
    assert all(isinstance(t, Fraction) for t in _targets(dict(sizes)).values())
    return out


def _pieces(rows):
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in rows:
        ids = [*model.encode(r[1] or "", add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), 2048):
            piece = ids[start : start + 2048]
            yield r[0], start, len(piece), zlib.crc32(np.asarray(piece, "<u4").tobytes()), len(ids)


def _run(spark, docs, rows):
    """Every stage on the one before it, each checked."""
    for (name, stage), brute in zip(corpus_pipeline.STAGES, (None, _exact, _near, _mix)):
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), docs.schema)
        rows = brute(rows) if brute else [r for r in rows if any(c.isalpha() for c in r[1] or "")]
        got = Counter((r.doc_id, r.text, r.source) for r in docs.collect())
        assert got == Counter((r[0], r[1], r[3]) for r in rows), name
    name, stage = corpus_pipeline.STAGES[-1]
    out = stage(spark, docs, "").collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out) == Counter(_pieces(rows))
    return len(rows)


def test_stages_are_named_and_registered():
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    assert "pipeline" in queries() and "pipeline" not in oracle_sql()
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries() if q.startswith("op")) == list(range(1, 11))


def test_pipeline_matches_brute_force_on_documents(spark):
    docs = load(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    assert 0 < _run(spark, docs, rows)


def test_pipeline_matches_brute_force_on_awkward_rows(spark):
    rows = [r for r in awkward_rows() if (r[1] is None or len(r[1]) < 5000)]
    # One row an id: which of several texts under one id an order puts first is not for this test.
    seen: dict = {}
    rows = [seen.setdefault(r[0], r) for r in rows if r[0] not in seen]
    assert 0 < _run(spark, documents(spark, rows), rows)


def test_run_equals_the_stages_and_an_empty_table_passes(spark, tmp_path):
    for name, rows in (("few", [(1, "a b c", "en", "web"), (2, "a  b c", "en", "web"), (3, "1 2", None, None)]), ("none", [])):
        documents(spark, rows).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert {r.doc_id for r in out} == ({1} if rows else set())


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_the_columns(spark, stage):
    docs = documents(spark, awkward_rows())
    assert corpus_pipeline.STAGES[stage][1](spark, docs, "").columns == docs.columns


@pytest.mark.parametrize("lang", ["en", None])
def test_texts_of_an_unlearned_script_stay(spark, lang):
    rows = [(i, f"the words of text number {i} in the house", lang, "web") for i in range(12)]
    rows += [(20, "今天天气很好我们去公园散步", None, "web"), (21, "12 34 --", None, "web"), (22, None, lang, "web"), (23, "", lang, "web"), (24, "Привет мир", None, "books")]
    kept = corpus_pipeline.language_id(spark, documents(spark, rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == [*range(12), 20, 24]
    assert 0 < _run(spark, documents(spark, rows), rows)
