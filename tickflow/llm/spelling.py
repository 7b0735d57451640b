"""Spelling variant grouping: words one edit apart, found by joins along a distributed trie.

Two words are near if one inserted, deleted or replaced code point makes one the
other.  The trie of all words is a table of edges (node, symbol, child), a node
being the prefix that leads to it.  States (word, position, node, edits) move
down it level by level: every level joins the frontier with the edges of its
depth, and a state that ends on a word with one edit has found a neighbour.

An edit leaves the first or the last half of a word as it is.  So two tries are
walked, of the words and of the words reversed, and edits are only made beyond
the half that must agree; up to there, and as long as it has made no edit, a
state is on the word's own path, which needs no join.  Of the own path only
nodes with several words below matter.  An edge knows a bit set of the symbols
that follow it and, if only one word lies below, that word, so states that
cannot go on are never made and a lone word is compared at once.

Words of more than ``LONGEST`` code points take no part in the walk as its
words (their paths would cost their length squared): they meet on the hashes of
their texts with one code point deleted and are compared in full, so the result
is exact at any length.  Both ways give rows (word, near word); pairs are found from either end.

Defined cases: a null text has no words; a null id reads as an empty string in
the rule that plants variants; rows and documents may repeat and count each
time; ties among near words go to the smallest in code-point order; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import look_up
from tickflow.session import scratch_path

RUN = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST = 7  # code points of a word
LEAST_N = 2  # occurrences of a word
MUCH = 10  # a form occurs so many times as often as the word
LONGEST = 64  # code points of a word that walks the trie


def words_of(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, word: every run of at least ``shortest`` letters, A-Z lower-cased."""
    found = F.regexp_extract_all("text", F.lit(f"{RUN}{{{shortest},}}"), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("word")).withColumn("word", F.translate("word", UPPER, LOWER))


def with_slips(words: DataFrame, shortest: int = SHORTEST, one_in: int = 31) -> DataFrame:
    """A code point is deleted from every run whose crc32 with its document's id ``one_in`` divides."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    at = (F.col("h") % F.length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    slipped = words.withColumn("h", h).withColumn("word", F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("word")))
    return slipped.filter(F.length("word") >= shortest).drop("h")


def counted(words: DataFrame, least: int = LEAST_N) -> DataFrame:
    """word, n of the words that occur at least ``least`` times."""
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Written to the shared folder and read there: cuts the lineage.  ``by``: a folder for each value."""
    path = scratch_path(df.sparkSession, f"spelling-{name}")
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def trie_paths(words: DataFrame) -> DataFrame:
    """side, word, depth: the nodes of each word's own path that several words share.

    ``word`` is reversed on side 1.  Nodes above the least half of a word are never asked for.
    """
    both = words.select(F.explode(F.array(F.struct(F.lit(0).alias("side"), "word"), F.struct(F.lit(1).alias("side"), F.reverse("word").alias("word")))).alias("w"))
    least = F.floor(F.lit(SHORTEST) / 2).cast("int")
    steps = both.select("w.side", "w.word", F.explode(F.sequence(least, F.length("w.word"))).alias("depth"))
    node = F.expr("substring(word, 1, depth)")
    shared = steps.groupBy("side", node.alias("node")).agg(F.count("*").alias("words")).filter("words > 1").select("side", "node")
    shared = _stored(shared, "nodes")
    on = (F.col("s.side") == F.col("n.side")) & (F.expr("substring(s.word, 1, s.depth)") == F.col("n.node"))
    return steps.alias("s").join(shared.alias("n"), on, "left_semi").select("side", "word", "depth")


# A bit set of symbols holds a code point's bit modulo this; the end of a word has the bit itself.
BITS = 63


def trie_edges(paths: DataFrame) -> DataFrame:
    """side, depth, node, symbol ('': a word ends), code (its code point or 0), lone (the only
    word below, else null), next (bit set of what follows)."""
    follows = f"CASE WHEN length(word) <= depth + 1 THEN {BITS} ELSE ascii(substring(word, depth + 2, 1)) % {BITS} END"
    steps = paths.withColumns(
        {"symbol": F.expr("substring(word, depth + 1, 1)"), "bit": F.expr(f"shiftleft(1L, {follows})"), "node": F.expr("substring(word, 1, depth)")}
    )
    grouped = steps.groupBy("node", "side", "depth", "symbol").agg(F.count("*").alias("words"), F.min("word").alias("lone"), F.bit_or("bit").alias("next"))
    lone = F.when(F.col("words") == 1, F.col("lone")).alias("lone")
    return grouped.select("side", "depth", "node", "symbol", F.ascii("symbol").alias("code"), lone, "next")


def _step(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """One level: every state against the edges of its node; what each edge lets it become.

    Of edits with the same result only one is made: a code point is inserted or
    deleted at the end of a run of equal ones.
    """
    # The next three code points of each state (0 beyond its word), so that an edge is judged by integers alone.
    codes = {f"c{k}": F.expr(f"ascii(substring(word, pos + {k + 1}, 1))") for k in range(3)}
    joined = frontier.withColumns(codes).join(edges.hint("shuffle_hash"), ["node", "side"])
    fresh = F.col("edits") == 0
    allowed = (
        fresh & (F.col("code") != 0) & (F.col("code") != F.col("c0")),  # the edge's symbol is inserted
        F.when(fresh, (F.col("code") != 0) & (F.col("c0") != 0) & (F.col("code") != F.col("c0"))).otherwise(F.col("code") == F.col("c0")),
        fresh & (F.col("c0") != 0) & (F.col("c0") != F.col("c1")) & (F.col("code") == F.col("c1")),  # c0 is deleted
    )
    follows = [F.expr(f"(code = 0) OR (shiftright(next, IF(c{k} = 0, {BITS}, c{k} % {BITS})) & 1L) = 1L") for k in range(3)]
    ok = [a & f for a, f in zip(allowed, follows)]
    moves = F.array_compact(F.array(*[F.when(o, F.lit(k)) for k, o in enumerate(ok)]))
    states = joined.filter(ok[0] | ok[1] | ok[2]).select("side", "word", "pos", "depth", "node", "symbol", "code", "lone", F.explode(moves).alias("move"))
    states = states.withColumn("pos", F.col("pos") + F.col("move"))
    # From here on the rest of the word must follow as it is.
    found = F.expr("CASE WHEN code = 0 THEN node WHEN substring(lone, depth + 2) = substring(word, pos + 1) THEN lone END")
    moved = states.withColumns({"found": found, "node": F.concat("node", "symbol")})
    moved = moved.filter(F.col("found").isNotNull() | F.col("lone").isNull())
    return moved.select("side", "word", "pos", (F.col("depth") + 1).alias("depth"), "node", "found")


def trie_neighbours(words: DataFrame) -> DataFrame:
    """word, near: the pairs one edit apart, from words of at most ``LONGEST`` code points."""
    paths = _stored(trie_paths(words.filter(F.length("word") <= LONGEST + 1)), "paths", by="depth")
    edges = _stored(trie_edges(paths), "edges", by="depth")
    # The half that agrees: floor(L / 2) code points in front, the others behind.
    half = F.when(F.col("side") == 0, F.floor(F.length("word") / 2)).otherwise(F.ceil(F.length("word") / 2))
    own = paths.filter((F.length("word") <= LONGEST) & (F.col("depth") >= half))
    own = own.select("side", "word", F.col("depth").alias("pos"), "depth", F.expr("substring(word, 1, depth)").alias("node"), F.lit(0).alias("edits"))
    levels = []
    moving = None
    last = paths.agg(F.max("depth")).first()[0]
    for depth in range(SHORTEST // 2, (last or 0) + 1):
        frontier = own.filter(F.col("depth") == depth)
        if moving is not None:
            frontier = frontier.unionByName(moving.withColumn("edits", F.lit(1)))
        here = edges.filter(F.col("depth") == depth).drop("depth")
        done = _stored(_step(frontier, here), f"level-{depth}")
        levels.append(done.filter("found IS NOT NULL").select("side", "word", F.col("found").alias("near")))
        moving = done.filter("found IS NULL").drop("found")
    if not levels:
        return words.select("word", F.col("word").alias("near")).limit(0)
    pairs = reduce(DataFrame.union, levels)
    back = lambda c: F.when(F.col("side") == 1, F.reverse(c)).otherwise(F.col(c))
    return pairs.select(back("word").alias("word"), back("near").alias("near"))


def long_neighbours(words: DataFrame) -> DataFrame:
    """word, near: the pairs one edit apart, from words of more than ``LONGEST`` code points.

    Such words share a text that each is, or becomes when it loses a code point; only the texts'
    hashes are shuffled.  Words that share one differ in a code point at most each, so a group is
    bounded by the alphabet and a word's length, whatever the data.
    """
    long = words.filter(F.length("word") >= LONGEST).select("word", F.xxhash64("word").alias("id"))
    shorter = "transform(sequence(0, length(word) - 1), i -> xxhash64(concat(substring(word, 1, i), substring(word, i + 2))))"
    shared = long.select("id", F.explode(F.array_distinct(F.array_append(F.expr(shorter), F.col("id")))).alias("text"))
    pairs = shared.join(shared.withColumnRenamed("id", "other"), "text").filter("id <> other").select("id", "other").distinct()
    near = long.select(F.col("word").alias("near"), F.col("id").alias("other"))
    found = pairs.join(long.filter(F.length("word") > LONGEST), "id").join(near, "other")
    return found.filter(F.levenshtein("word", "near", 1) == 1).select("word", "near")


def neighbours(words: DataFrame) -> DataFrame:
    """word, near: all pairs of the distinct words one edit apart, both ways."""
    return trie_neighbours(words).union(long_neighbours(words)).distinct()


def variants(counts: DataFrame, much: int = MUCH) -> DataFrame:
    """word, n, n_near, form (its commonest near word, if ``much`` times as common), form_n, root (the last form)."""
    counts = _stored(counts, "words")
    pairs = neighbours(counts.select("word"))
    near_n = counts.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    # Commonest first, then smallest in code-point order: both by one maximum and one minimum.
    known = pairs.join(near_n, "near").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top")
    )
    common = -F.col("top.less") >= F.col("n") * much
    forms = counts.join(known, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(common, F.col("top.near")).alias("form"), F.when(common, -F.col("top.less")).alias("form_n"),
    )
    forms = _stored(forms, "forms")
    # A form is ``much`` times as common as its word, so chains are short: their length is a logarithm of the counts.
    step = forms.filter("form IS NOT NULL").select(F.col("word").alias("root"), F.col("form").alias("onward"))
    roots = forms.withColumn("root", F.coalesce("form", "word"))
    while True:
        moved = look_up(roots, step, ["root"], "left")
        roots = _stored(moved.withColumn("root", F.coalesce("onward", "root")).withColumn("moved", F.col("onward").isNotNull()).drop("onward"), "roots")
        if roots.filter("moved").isEmpty():
            return roots.select("word", "form", "root", "n", "n_near", "form_n")
        roots = roots.drop("moved")
