"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size long, `key` string"


def documents(spark: SparkSession, rows) -> DataFrame:
    """Rows (doc_id, text[, lang[, source]]) with extra columns whose names clash with results."""
    full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1]), None, 7, "k") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def awkward_texts(seed: int = 0) -> list[str | None]:
    """Null, empty, blank, one word, non-ASCII blanks, repeats, a long text and near copies."""
    rng = random.Random(seed)
    vocabulary = ["alpha", "beta", "Gamma", "delta", "épsilon", "zeta", "ETA", "theta", "iota", "κappa", "x y", "naïve", "9", "**"]
    base = [rng.choice(vocabulary) for _ in range(60)]
    texts: list[str | None] = [None, "", " \t\n", "one", "a b", "a\x0bb\x0cc", "A b  c", "a B c", "été   x", "1 2 3 ***"]
    for i in range(12):
        words = list(base)
        for _ in range(i % 4):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    passage = " ".join(f"w{j}" for j in range(70))
    for i in range(10):
        lead = " ".join(rng.choice(vocabulary) + str(rng.randrange(50)) for _ in range(rng.randrange(40)))
        tail = "\n".join(rng.choice(vocabulary) + str(rng.randrange(50)) for _ in range(rng.randrange(40)))
        texts.append(f"{lead} {passage}\t{tail}" if i % 2 else f"{lead} {tail}")
    texts.append(" ".join(rng.choice(vocabulary) + str(rng.randrange(3000)) for _ in range(30_000)))
    texts += [texts[-1], texts[10], texts[10]]
    return texts


def awkward_rows(seed: int = 0) -> list[tuple]:
    langs, sources = ["en", "fr", None], ["web", "books", None, "code", "Web"]
    rows = [(3 * i, t, langs[i % 3], sources[i % 5]) for i, t in enumerate(awkward_texts(seed))]
    rows += [rows[12], rows[12], (rows[12][0], "another text under a repeated id", "en", "web")]
    rows += [(None, "no id here", None, None), (None, rows[14][1], "fr", "web"), (-5, rows[15][1], "en", None)]
    return rows
