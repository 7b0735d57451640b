import re
import time
from collections import Counter

import pytest
from awkward import awkward_rows, documents

from tickflow.llm import licenses
from tickflow.llm.licenses import BASE, digest, rules, scan

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

TEXTS = [
    "Licensed under the Apache License, Version 2.0. All rights reserved.",
    "Released under the MIT License.\nLicensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "CC BY cc by cc by CC-BY-SA 4.0",
    "SPDX-License-Identifier: GPL-2.0-only or the GPL, GPL GPL v2",
    "general public license general public license, ALL RIGHTS   RESERVED",
    "ccé by cc byé submit committee accby",
    "Copyright (c) 2019 2020 Someone. Creative Commons Attribution-ShareAlike 3.0 and Creative Commons Attribution Share Alike",
    "apache", "the unlicense or public domain", "licensed under licensed under the terms of the LGPL 2.1",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software. Redistribution and use in source and binary forms, with or without modification, are permitted",
    "neither the name of a b c nor the names of its contributors may be used to endorse or promote products; you may not use this file except in compliance with the license",
]


def brute(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lowered)
    places = []
    base = set()
    for phrase, label in BASE.items():
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    spaced = "".join(f" {w} " for w in words)
    found = []
    for r in rules():
        if f" {r.keyword} " in spaced:
            found += [(m.start(), m.end(), r) for m in re.finditer(r.pattern, spaced)]
    kept = []
    for i, (a, b, r) in enumerate(found):
        hidden = any(
            c <= a and b <= d and q.priority >= r.priority and (d - c, q.priority, [-x for x in q.name.encode()] + [1]) > (b - a, r.priority, [-x for x in r.name.encode()] + [1])
            for j, (c, d, q) in enumerate(found)
            if i != j
        )
        if not hidden:
            kept.append((a, b, r.name))
    labels = base | {r.label for a, b, r in found if (a, b, r.name) in kept}
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), sorted(set(kept))


def test_signatures_hold_their_keyword_and_match_their_texts(spark):
    texts = {
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\")",
        "bsd": "Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that",
        "bsd-3-clause": "Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived",
        "gpl-2.0-or-later": "either version 2 of the License, or (at your option) any later version.",
        "apache-2.0": "you may not use this file except in compliance with the License.",
        "zlib": "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
        "unlicense": "This is free and unencumbered software released into the public domain.",
        "proprietary": "Unauthorized copying of this file, via any medium is strictly prohibited",
        "non-commercial": "free for private non-commercial use only",
    }
    clean = ["the court granted permission to use the hall for any purpose", "a person obtaining a copy of the key", "the origin of the word is not known"]
    rows = list(enumerate([*texts.values(), *clean]))
    got = {r.doc_id: set(r.labels) for r in scan(documents(spark, rows)).collect()}
    assert all(label in got[i] for i, label in enumerate(texts)) and not any(got[len(texts) + i] for i in range(len(clean)))
    for label, _confidence, keyword, words in licenses.SIGNATURES:
        always = words
        while re.search(r"\(", always):
            always = re.sub(r"\((?:\?:)?[^()]*\)(?:[?+]|\{[0-9,]+\})?", "", always)
        assert keyword in always.split(), (label, words)


def test_scan_matches_brute_force(spark):
    rows = [*awkward_rows(), *((1000 + i, t) for i, t in enumerate(TEXTS)), (2000, " ".join(TEXTS * 30))]
    found = scan(documents(spark, rows))
    spans = {r.doc_id: sorted((d.start, d.stop, d.rule) for d in r.detections) for r in found.collect() if r.doc_id and r.doc_id >= 1000}
    out = digest(found).collect()
    want = Counter((r[0], *brute(r[1])[:6]) for r in rows)
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in out) == want
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") for r in out)
    for r in rows:
        if r[0] and r[0] >= 1000:
            assert spans[r[0]] == brute(r[1])[6]


def test_known_texts(spark):
    out = {r.doc_id: r.labels for r in digest(scan(documents(spark, list(enumerate(TEXTS))))).collect()}
    assert out[0] == "apache-2.0,reserved"
    assert out[1] == "cc-by,cc-by-nc-4.0,mit"
    assert out[2] == "gpl,gpl-3"
    assert out[8] == ""


def test_rules_are_many_and_gated():
    table = rules()
    assert len(table) > 300 and len({r.pattern for r in table}) == len(table)
    for r in table:
        assert re.search(rf"(?<![a-z0-9]){r.keyword}(?![a-z0-9])", r.pattern)
        re.compile(r.pattern)


def test_no_python_and_no_shuffle(spark):
    plan = digest(scan(documents(spark, [(1, "x")])))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


def test_empty(spark):
    assert scan(documents(spark, [])).count() == 0


@pytest.mark.parametrize("label", ["cc-by", "gpl", "reserved"])
def test_base_labels_stay(label):
    assert label in licenses.BASE.values()


def test_work_grows_with_the_matches_of_a_text_not_their_square(spark):
    def seconds(n):
        start = time.perf_counter()
        (row,) = scan(documents(spark, [(1, "the unlicense words. " * n)])).collect()
        assert len(row.detections) == n and row.labels == ["unlicense"]
        assert [d.start for d in row.detections] == [i * (row.detections[1].start - row.detections[0].start) for i in range(n)]
        return time.perf_counter() - start

    seconds(500)
    assert seconds(16_000) < 3.5 * seconds(8_000)  # the square would be 4 times
