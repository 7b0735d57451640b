"""License scans: ordered signature rules over normalised words, in native columns only.

Texts are lower-cased (A-Z) and cut into words of letters and digits.  Base
phrases are counted at every place.  Beyond them, rules (a regular expression
each, gated by a keyword that every match contains) are run where their keyword
occurs.  Detections carry their rule's priority; one that lies within another
of the same or a higher priority is suppressed, so "apache license version 2 0"
hides the bare "apache license" inside it.

Rules come from ``FAMILIES`` by ``FORMS``: every form of naming a license
(identifier tag, grant, name with version, bare name, address) becomes one
regular expression per license and version.  ``SIGNATURES`` holds sentences of
license texts and notices, so that a text is known that names no license.

The scan is one map-only pass: no shuffle, no UDF.

Defined cases: a null or wordless text has 0 words, no place (null) and no
label; places may share no word; rows that repeat are scanned each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import text_or_empty
from tickflow.llm.spans import find_all, fold

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# --- fixed values: base phrases and their labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# --- fixed values: licenses.  (label, names as words, versions as words)
FAMILIES = [
    ("apache", "apache(?: software)?(?: public)? license|apache", ["1 0", "1 1", "2 0"]),
    ("mit", "mit license|mit x11 license|expat license|mit", [""]),
    ("bsd-2-clause", "simplified bsd license|freebsd license|bsd 2 clause(?: license)?", [""]),
    ("bsd-3-clause", "new bsd license|modified bsd license|bsd 3 clause(?: license)?", [""]),
    ("bsd-4-clause", "original bsd license|bsd 4 clause(?: license)?", [""]),
    ("bsd", "bsd license|bsd style license|bsd", [""]),
    ("gpl", "(?:gnu )?general public license|gnu gpl|gpl", ["1", "1 0", "2", "2 0", "3", "3 0"]),
    ("lgpl", "(?:gnu )?lesser general public license|gnu library general public license|gnu lgpl|lgpl", ["2", "2 0", "2 1", "3", "3 0"]),
    ("agpl", "(?:gnu )?affero general public license|gnu agpl|agpl", ["1 0", "3", "3 0"]),
    ("gfdl", "gnu free documentation license|gfdl|gnu fdl", ["1 1", "1 2", "1 3"]),
    ("mpl", "mozilla public license|mpl", ["1 0", "1 1", "2 0"]),
    ("epl", "eclipse public license|epl", ["1 0", "2 0"]),
    ("eupl", "european union public licen[cs]e|eupl", ["1 0", "1 1", "1 2"]),
    ("cddl", "common development and distribution license|cddl", ["1 0", "1 1"]),
    ("cpl", "common public license|cpl", ["1 0"]),
    ("artistic", "artistic license", ["1 0", "2 0"]),
    ("isc", "isc license|isc", [""]),
    ("zlib", "zlib libpng license|zlib license|zlib", [""]),
    ("bsl", "boost software license|boost license", ["1 0"]),
    ("unlicense", "the unlicense|unlicense", [""]),
    ("wtfpl", "do what the f ck you want to public license|wtfpl", ["2"]),
    ("ofl", "sil open font license|open font license|ofl", ["1 0", "1 1"]),
    ("odbl", "open database license|odbl", ["1 0"]),
    ("psf", "python software foundation license|psf license", ["2"]),
    ("postgresql", "postgresql license", [""]),
    ("ms-pl", "microsoft public license|ms pl", [""]),
    ("ms-rl", "microsoft reciprocal license|ms rl", [""]),
    ("public-domain", "public domain", [""]),
    ("cc0", "creative commons zero|cc0|cc zero", ["1 0"]),
    ("cc-by", "creative commons attribution|cc by", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-sa", "creative commons attribution share ?alike|cc by sa", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc", "creative commons attribution non ?commercial|cc by nc", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nd", "creative commons attribution no ?deriv(?:ative)?s|cc by nd", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike|cc by nc sa", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc-nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s|cc by nc nd", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("proprietary", "proprietary (?:software )?license|proprietary and confidential", [""]),
    ("reserved", "(?:all|some|no) rights(?: are)? reserved", [""]),
    ("copyright", "copyright(?: c)?(?: [0-9]{4})+", [""]),
]

# --- fixed values: forms of naming a license.  (form, priority, confidence, expression)
# NAME and VERSION stand for the family's; a form without VERSION holds once per family.
FORMS = [
    ("tag", 3, 1.0, "spdx license identifier (?:NAME)(?: v)?(?: VERSION)?(?: only| or later)?"),
    ("grant", 3, 0.95, "(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?"
                       "(?:NAME)(?: license)?(?: (?:v|version))? VERSION(?: or (?:any )?later(?: version)?)?"),
    ("grant", 3, 0.9, "(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?(?:NAME)"),
    ("version", 2, 0.8, "(?:NAME)(?: license)?(?: (?:v|version))? VERSION(?: international)?"),
    ("name", 1, 0.6, "(?:NAME)"),
]

# --- fixed values: sentences of license texts and notices, written one by one.  (label, confidence, keyword, expression)
SIGNATURES = [
    ("mit", 0.95, "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this (?:software|font software|work)(?: and associated documentation files)?"),
    ("mit", 0.9, "sublicense", "to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", 0.85, "substantial", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", 0.7, "noninfringement", "merchantability fitness for a particular purpose and noninfringement"),
    ("mit-0", 0.9, "sell", "and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided as is"),
    ("isc", 0.95, "fee", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", 0.8, "tortious", "whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("hpnd", 0.9, "fee", "permission to use copy modify and distribute this software and its documentation for any purpose(?: and)? without fee is hereby granted"),
    ("hpnd", 0.7, "publicity", "not be used in advertising or publicity pertaining to distribution of the software"),
    ("bsd", 0.9, "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", 0.8, "redistributions", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", 0.8, "redistributions", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-3-clause", 0.9, "endorse", "neither the names? of(?: \\S+){1,12} nor the names of (?:its|their|the) (?:\\S+ )?contributors may be used to endorse or promote products"),
    ("bsd-4-clause", 0.9, "advertising", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", 0.7, "exemplary", "direct indirect incidental special exemplary or consequential damages"),
    ("bsd-source-code", 0.7, "unmodified", "redistributions of source code must retain the above copyright notice unmodified"),
    ("apache-2.0", 0.95, "compliance", "you may not use this file except in compliance with the license"),
    ("apache-2.0", 0.95, "warranties", "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-2.0", 0.9, "specific", "see the license for the specific language governing permissions and limitations under the license"),
    ("apache-2.0", 0.85, "irrevocable", "perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|except as stated in this section patent) license"),
    ("apache-1.1", 0.9, "developed", "this product includes software developed by the apache software foundation"),
    ("gpl", 0.95, "redistribute", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", 0.9, "redistribute", "is free software you can redistribute it and or modify it under the terms of (?:version [0-9] of )?the gnu general public license"),
    ("gpl", 0.8, "merchantability", "without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl", 0.85, "received", "you should have received a copy of the gnu general public license"),
    ("gpl", 0.8, "verbatim", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl", 0.8, "freedom", "licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-2.0-or-later", 0.95, "option", "either version 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", 0.95, "option", "either version 3 of the license or at your option any later version"),
    ("gpl-3.0", 0.85, "copyleft", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl-with-classpath-exception", 0.85, "linking", "linking this library statically or dynamically with other modules is making a combined work based on this library"),
    ("gpl-with-linking-exception", 0.8, "exception", "as a special exception the copyright holders(?: of this library)? give you permission to link"),
    ("lgpl", 0.95, "redistribute", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("lgpl", 0.85, "received", "you should have received a copy of the gnu (?:lesser|library) general public license"),
    ("lgpl-2.1-or-later", 0.95, "option", "either version 2 1 of the license or at your option any later version"),
    ("agpl", 0.95, "affero", "redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("agpl", 0.85, "received", "you should have received a copy of the gnu affero general public license"),
    ("agpl", 0.7, "remotely", "all users interacting with it remotely through a computer network"),
    ("gfdl", 0.9, "invariant", "with no invariant sections(?: with)? no front cover texts and no back cover texts"),
    ("gfdl", 0.9, "document", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2.0", 0.95, "form", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", 0.8, "obtain", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-1.1", 0.95, "contents", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl", 0.9, "accompanying", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cddl", 0.9, "contents", "the contents of this file are subject to the terms of (?:either the gnu general public license version 2 only gpl or )?the common development and distribution license"),
    ("eupl", 0.85, "eupl", "licensed under the eupl(?: version [0-9] [0-9])? or as soon they will be approved by the european commission"),
    ("zlib", 0.95, "express", "this software is provided as is without any express or implied warranty in no event will the authors? be held liable for any damages arising from the use of this software"),
    ("zlib", 0.9, "misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("bsl-1.0", 0.95, "organization", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("unlicense", 0.95, "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", 0.9, "verbatim", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"),
    ("ofl", 0.95, "font", "this font software is licensed under the sil open font license"),
    ("ofl", 0.85, "reserved", "no modified version of the font software may use the reserved font name"),
    ("artistic", 0.85, "artistic", "you can redistribute it and or modify it under the (?:same )?terms of the artistic license"),
    ("perl", 0.9, "perl", "you can redistribute it and or modify it under the same terms as perl itself"),
    ("postgresql", 0.85, "paragraph", "provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies"),
    ("psf", 0.85, "licensee", "psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("cc0", 0.9, "neighboring", "(?:has|have) (?:waived|dedicated|waived all copyright)(?: \\S+){0,10} and related or neighboring rights"),
    ("public-domain", 0.85, "domain", "(?:this|the) (?:software|work|file|code|document|book|text) is (?:hereby )?(?:placed |released |dedicated )?(?:in|into|to) the public domain"),
    ("public-domain", 0.8, "disclaims", "the author disclaims copyright to this source code"),
    ("beerware", 0.9, "beer", "if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    ("json", 0.9, "evil", "the software shall be used for good not evil"),
    ("commons-clause", 0.9, "grant", "the grant of rights under the license will not include and the license does not grant to you the right to sell the software"),
    ("sspl", 0.85, "service", "if you make the functionality of the program or a modified version available to third parties as a service"),
    ("busl", 0.85, "production", "make non production use of the licensed work"),
    ("proprietary", 0.8, "prohibited", "unauthorized (?:copying|use|reproduction|duplication|distribution)(?: \\S+){0,12} is strictly prohibited"),
    ("proprietary", 0.8, "written", "(?:reproduced|copied|distributed|transmitted|disclosed)(?: \\S+){0,15} without the (?:prior )?(?:express )?(?:prior )?written (?:permission|consent) of"),
    ("proprietary", 0.75, "confidential", "(?:contains|constitutes)(?: \\S+){0,4} confidential(?: and)? (?:proprietary|trade secret) (?:information|material)"),
    ("non-commercial", 0.75, "only", "(?:for|free for)(?: \\S+){0,3} non ?commercial (?:use|purposes) only"),
]

# Names so short that only a tag, a grant or a version makes them a license.
BARE_TOO_SHORT = {"mit", "apache", "bsd", "isc", "zlib", "mpl", "epl", "cpl"}

BASE_SCORE = 0.5


class Rule(NamedTuple):
    name: str
    label: str
    keyword: str  # a word of every match
    pattern: str  # over words that each have a space on either side
    priority: int
    confidence: float


def _alternatives(names: str) -> list[str]:
    """Alternatives at the outer level."""
    out, depth, now = [], 0, ""
    for c in names:
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            out.append(now)
            now = ""
        else:
            now += c
    return [*out, now]


def _keyword(name: str) -> str:
    """The longest word that every match of the name holds."""
    fixed = re.sub(r"\(\?:[^()]*\)[?+]?", "", re.sub(r"\S* \?\S*", "", name))
    return max(re.findall(r"(?<!\S)[a-z0-9]+(?!\S)", fixed), key=len)


def rules() -> list[Rule]:
    """Every form of every name and version of a license, then the sentences of texts, in the order of the tables."""
    made: dict[str, Rule] = {}
    for label, names, versions in FAMILIES:
        for name in _alternatives(names):
            for form, priority, confidence, expression in FORMS:
                if form == "name" and name in BARE_TOO_SHORT:
                    continue
                for version in [v for v in versions if v] if "VERSION" in expression else [""]:
                    words = expression.replace("NAME", name).replace("VERSION", version)
                    # Between two words stand the spaces of both; an optional space joins them.
                    pattern = "(?:  )?".join(part.replace(" ", "  ") for part in words.split(" ?"))
                    own = label + ("-" + version.replace(" ", ".") if version else "")
                    made.setdefault(pattern, Rule(f"{own}/{form}", own, _keyword(name), f" {pattern} ", priority, confidence))
    for i, (label, confidence, keyword, words) in enumerate(SIGNATURES):
        made_of = "(?:  )?".join(part.replace(" ", "  ") for part in words.split(" ?"))
        made.setdefault(made_of, Rule(f"{label}/text-{i}", label, keyword, f" {made_of} ", 3, confidence))
    return list(made.values())


def _normal_words() -> Column:
    """The words, each with one space on either side of all: `` w1 w2 ``; ``"  "`` without any."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text_or_empty()), NOT_WORD, " ")), F.lit(" "))


def _spaces(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels (arrays), detections, score.

    ``detections``: those that no other suppresses, as (start, stop) in the
    characters of the normalised words, rule, label, priority, confidence.
    """
    table = rules()
    keywords = sorted({r.keyword for r in table})
    words = docs.select("doc_id", _normal_words().alias("w_")).withColumn(
        "n_words", F.when(F.col("w_") == "  ", 0).otherwise(_spaces(F.col("w_")) - 1).cast("long")
    )
    # Each word with spaces of its own, for texts that any phrase or keyword occurs in.
    gate = " (?:" + "|".join([*BASE, *keywords]) + ") "
    gated = words.withColumn("d_", F.when(F.col("w_").rlike(gate), F.replace("w_", F.lit(" "), F.lit("  "))))
    gated = gated.withColumn("d_", F.expr("substring(d_, 2, length(d_) - 2)")).drop("w_")

    based = _base(gated)
    present = F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(F.col("d_"), F.concat(F.lit(" "), k, F.lit(" "))))
    found = based.withColumn("all_", F.when(F.col("d_").isNotNull(), _detections(table, present)).otherwise(F.array().cast(FOUND)))
    kept = found.withColumn("detections", _unsuppressed(F.col("all_"))).drop("all_", "d_")
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", F.transform("detections", lambda d: d["label"]))))
    best = F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0))
    score = F.greatest(best, F.when(F.col("n_base") > 0, BASE_SCORE).otherwise(0.0))
    return kept.withColumn("labels", labels).withColumn("score", score)


def _base(gated: DataFrame) -> DataFrame:
    """Places of the base phrases: their number, smallest and largest start, labels."""
    text, reverse = F.col("d_"), F.reverse("d_")
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE.items():
        sought = f" {phrase.replace(' ', '  ')} "
        holds = F.contains(text, F.lit(sought))
        without = F.octet_length(F.replace(text, F.lit(sought), F.lit("")))
        counts.append(F.when(holds, (F.octet_length(text) - without) / len(sought)).otherwise(0).cast("long"))
        ahead = F.substring_index(text, sought, 1)
        firsts.append(F.when(holds, (_spaces(ahead) / 2).cast("long")))
        behind = F.substring_index(reverse, sought[::-1], 1)
        lasts.append(F.when(holds, F.col("n_words") - (_spaces(behind) / 2).cast("long") - len(phrase.split())))
        labels.append(F.when(holds, F.lit(label)))
    return gated.select(
        "*",
        sum(counts[1:], counts[0]).alias("n_base"),
        F.least(*firsts).alias("first_word"),
        F.greatest(*lasts).alias("last_word"),
        F.array_sort(F.array_compact(F.array(*labels))).alias("base_labels"),
    )


DETECTION = "struct<start:int,stop:int,rule:string,label:string,priority:int,confidence:double>"
FOUND = f"array<{DETECTION}>"


def _detections(table: list[Rule], present: Column) -> Column:
    """All matches of the rules whose keyword is present, ordered so that one comes after those that may suppress it."""
    by_keyword: dict[str, list[dict]] = {}
    for r in table:
        own = {"rule": r.name, "label": r.label, "pattern": r.pattern, "priority": r.priority, "confidence": r.confidence}
        by_keyword.setdefault(r.keyword, []).append(own)
    rule = "struct<rule:string,label:string,pattern:string,priority:int,confidence:double>"
    gated = F.from_json(F.lit(json.dumps(by_keyword)), f"map<string,array<{rule}>>")  # a constant
    tried = F.flatten(F.transform(present, lambda k: F.element_at(gated, k)))

    def matches(r: Column) -> Column:
        return F.transform(
            find_all(F.col("d_"), r["pattern"]),
            lambda m: F.struct(
                m["start"].alias("start"), m["stop"].alias("stop"), r["rule"].alias("rule"), r["label"].alias("label"),
                r["priority"].alias("priority"), r["confidence"].alias("confidence"),
            ),
        )

    # By start, then falling stop and priority, then rule.
    key = lambda d: F.struct(d["start"], -d["stop"], -d["priority"], d["rule"])
    keyed = F.transform(F.flatten(F.transform(tried, matches)), lambda d: F.struct(key(d).alias("k"), d.alias("d")))
    return F.transform(F.array_sort(keyed), lambda x: x["d"])


def _unsuppressed(ordered: Column) -> Column:
    """One sweep: a detection goes if an earlier one of its priority or a higher one reaches as far."""
    reach = ["r1", "r2", "r3"]  # furthest stop so far of each priority

    def step(held: Column, d: Column) -> Column:
        hidden = F.greatest(*[F.when(d["priority"] <= p, held[f"r{p}"]).otherwise(-1) for p in (1, 2, 3)]) >= d["stop"]
        far = [F.when(d["priority"] == p, F.greatest(held[f"r{p}"], d["stop"])).otherwise(held[f"r{p}"]).alias(f"r{p}") for p in (1, 2, 3)]
        return F.struct(*far, F.when(hidden, held["out"]).otherwise(F.concat(held["out"], F.array(d))).cast(FOUND).alias("out"))

    return fold(ordered, {r: F.lit(-1) for r in reach}, step, DETECTION)


def digest(found: DataFrame) -> DataFrame:
    """The scan's row per document with labels as comma-joined text."""
    return found.select(
        "doc_id", "n_words", F.col("n_base").cast("long").alias("n_base"), "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def oracle() -> str:
    """DuckDB text of ``digest(scan(documents))``, from the same tables of rules and phrases."""
    quote = lambda text: "'" + text.replace("'", "''") + "'"
    table = ",\n  ".join(f"({quote(r.name)}, {quote(r.label)}, {quote(r.keyword)}, {quote(r.pattern)}, {r.priority}, {r.confidence})" for r in rules())
    places = " UNION ALL ".join(
        f"SELECT doc_id, {quote(label)} AS label, i - 1 AS place FROM spaced, unnest(range(1, len(words) + 1)) AS t(i) "
        f"WHERE words[i:i + {len(phrase.split()) - 1}] = {phrase.split()}"
        for phrase, label in BASE.items()
    )
    return rf"""
WITH rules(rule, label, keyword, pattern, priority, confidence) AS (VALUES
  {table}),
spaced AS (
  SELECT doc_id, words, CASE WHEN len(words) > 0 THEN ' ' || array_to_string(words, '  ') || ' ' ELSE '' END AS d
  FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents)),
places AS ({places}),
base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list_sort(list(DISTINCT label)) AS labels
  FROM places GROUP BY doc_id),
tried AS (
  SELECT doc_id, r.*, regexp_extract_all(d, pattern) AS m, string_split_regex(d, pattern) AS g
  FROM spaced JOIN rules r ON contains(d, ' ' || keyword || ' ')),
found AS (
  SELECT doc_id, rule, label, priority, confidence, sum_g + sum_m AS start, sum_g + sum_m + length(m[i]) AS stop
  FROM (SELECT *, list_sum([0] || list_transform(g[1:i], lambda x: length(x))) AS sum_g,
               list_sum([0] || list_transform(m[1:i - 1], lambda x: length(x))) AS sum_m
        FROM tried, unnest(range(1, len(m) + 1)) AS t(i))),
kept AS (
  SELECT * FROM found f WHERE NOT EXISTS (
    SELECT 1 FROM found e WHERE e.doc_id = f.doc_id AND e.priority >= f.priority AND e.stop >= f.stop
      AND (e.start, -e.stop, -e.priority, e.rule) < (f.start, -f.stop, -f.priority, f.rule))),
own AS (SELECT doc_id, list(DISTINCT label) AS labels, max(confidence) AS best FROM kept GROUP BY doc_id)
SELECT s.doc_id, len(words) AS n_words, coalesce(b.n_base, 0) AS n_base, b.first_word, b.last_word,
       coalesce(array_to_string(b.labels, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(coalesce(b.labels, []) || coalesce(o.labels, []))), ',') AS labels,
       greatest(coalesce(o.best, 0)::DOUBLE, CASE WHEN b.n_base > 0 THEN {BASE_SCORE} ELSE 0 END::DOUBLE) AS score
FROM spaced s LEFT JOIN base b USING (doc_id) LEFT JOIN own o USING (doc_id)"""
