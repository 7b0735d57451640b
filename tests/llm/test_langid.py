import zlib
from collections import Counter

import pytest
from awkward import awkward_rows, documents

from tickflow.llm import langid
from tickflow.llm.common import load

SF = "/root/testdata/sf0.01"


def brute_counts(text):
    lowered = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    found = Counter()
    for word in lowered.split():
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                if gram != " ":
                    found[gram] += 1
    return found


def _code(gram):
    code = 0
    for c in gram:
        code = code << 21 | (1 if c == " " else ord(c))
    return code


@pytest.mark.parametrize("cut", [1 << 18, 3])
def test_counts_match_brute_force(monkeypatch, cut):
    monkeypatch.setattr(langid, "SLICE", cut)
    for text in [None, "", "... 12", "a", "Der Öl-Tank, naïve ÉTÉ", "x y  zz\nZ", "日本語 テスト"]:
        codes, counts = langid.gram_counts(None if text is None else text.encode())
        assert dict(zip(codes.tolist(), counts.tolist())) == {_code(g): n for g, n in brute_counts(text).items()}


def test_distance_matches_definition():
    profiles = {"aa": [_code(g) for g in ("e", "t", "th", "he")], "bb": [_code(g) for g in ("z", "e", "q")]}
    judge = langid.Judge(profiles, 4)
    text = b"the the z"
    top = sorted(brute_counts(text.decode()).items(), key=lambda x: (-x[1], _code(x[0])))[:4]
    away = {
        lang: sum(abs(ranked.index(_code(g)) - i) if _code(g) in ranked else 4 for i, (g, _) in enumerate(top))
        for lang, ranked in profiles.items()
    }
    lang, score = judge.predict(text)
    assert lang == min(away, key=lambda x: (away[x], x)) and score == pytest.approx(1 - away[lang] / (4 * len(top)))


def test_held_out_accuracy_and_contract(spark):
    docs = load(spark, SF, "documents")
    out = {r.doc_id: r for r in langid.identify(docs).collect()}
    rows = docs.collect()
    assert len(out) == len(rows)
    right = total = 0
    for r in rows:
        found = out[r.doc_id]
        assert found.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= found.score <= 1
        if found.held_out and any(c.isalpha() for c in r.text):
            total += 1
            right += found.lang_pred == r.lang
    assert right / total > 0.97


def test_prediction_uses_text_only(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in load(spark, SF, "documents").limit(300).collect()]
    held = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    other = [(i, t, "xx" if i in held else lang, "s") for i, t, lang, _ in rows]
    a, b = (sorted(map(str, langid.identify(documents(spark, r)).collect())) for r in (rows, other))
    assert a == b


def test_awkward_rows(spark):
    rows = awkward_rows()
    out = langid.identify(documents(spark, rows)).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    blank = {r[0] for r in rows if r[0] is not None and not any(c.isalpha() for c in r[1] or "")}
    assert all((r.lang_pred == "und") == (r.doc_id in blank) for r in out if r.doc_id is not None)
    assert langid.identify(documents(spark, [])).count() == 0
    unlabelled = langid.identify(documents(spark, [(1, "some text"), (2, None)])).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def test_stage_keeps_columns_and_drops_only_und(spark):
    rows = awkward_rows()
    docs = documents(spark, rows)
    kept = langid.identified_documents(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(any(c.isalpha() for c in r[1] or "") for r in rows)
