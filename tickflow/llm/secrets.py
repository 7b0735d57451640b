"""Secret scans: candidates by rule, false positives removed by a random forest.

A candidate is a run of at least ``LEAST_CHARS`` key characters that holds a
digit, the value that follows a name like password, token or API key (quoted:
all up to the closing quote; else up to white space, a quote or the next
``name=``), or a vendor's key form, found in the whole text.  A value may hold
a run; both are findings then, but equal ones are one.  Its features are its
length, how its
characters change class from one to the next, the share that dictionary words
cover, path marks and the neighbouring words.  The forest (Spark ML) learns
from labelled findings, a bounded sample of ``MOST_LABELLED`` distinct ones of
either label (those that hash lowest), and scores every candidate; a score under
``THRESHOLD`` is a false positive.

Where no labels are at hand, ``seed_labels`` labels the findings whose form or
neighbours leave no doubt: vendors' key formats and values assigned to a
password, token or key are secrets if they are a run or mix letters with digits
or signs; numbers, UUIDs, digests, addresses, placeholders, literals, code and
a bare word without quotes are not.  All else is left to the forest.

Everything is native columns and Spark ML: candidates are found by a map-only
pass, and only they are kept.

Defined cases: a null or empty text has no candidate; rows that repeat are
scanned each, a null id like any other; with labels of one kind only (or none)
no forest is grown, and the score is that label's value for the labelled, 0.5
for others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase, digits

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import settle, text_or_empty
from tickflow.llm.spans import find_all

LEAST_CHARS = 16
CONTEXT = 48
MOST_LABELLED = 10_000
TREES, DEPTH, SEED = 24, 6, 7
THRESHOLD = 0.5

RUN = "[A-Za-z0-9+/_-]"
CANDIDATE = r"(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}={0,2}"

# --- fixed values: forms of keys, marks of what is no key, words
VENDOR_KEYS = {
    "aws-access-key": r"^(?:AKIA|ASIA)[0-9A-Z]{16}$",
    "github-token": r"^gh[pousr]_[0-9A-Za-z]{36,}$",
    "slack-token": r"^xox[abprs]-[0-9A-Za-z-]{10,}$",
    "stripe-key": r"^[rs]k_(?:live|test)_[0-9A-Za-z]{16,}$",
    "google-api-key": r"^AIza[0-9A-Za-z_-]{35}$",
    "gitlab-token": r"^glpat-[0-9A-Za-z_-]{20,}$",
    "npm-token": r"^npm_[0-9A-Za-z]{36}$",
}
NAME = r"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key|credential)s?"
STAGE = r"(?:[_-](?i:production|prod|staging|development|dev|test|live|main|old|new|[0-9]{1,3}))*"
ASSIGN = NAME + STAGE + r"[\"'`]?\s*(?:=>|:=|={1,3}|:)\s*"
ASSIGNED = ASSIGN + r"[\"'`]?$"
# Possessive loops: they neither go back nor recurse, however long the value is.
QUOTED = "|".join(rf"{q}(?:[^{q}\\\n]|\\.)*+{q}" for q in "\"'`")
UNQUOTED = r"[\"'`]?(?:[^\s\"'`,;&]|[,;&](?!\s|[A-Za-z_][A-Za-z0-9_.-]*=))++"
VENDOR = rf"(?<![0-9A-Za-z])(?:{'|'.join(form[1:-1] for form in VENDOR_KEYS.values())})(?![0-9A-Za-z])"
VALUE = f"{ASSIGN}(?:{QUOTED}|{UNQUOTED})|{VENDOR}"
# What is assigned but plainly no secret, and what plainly is one; of whole values that are no run.
NO_VALUE = (
    r"(?i)^(?:null|none|nil|undefined|true|false|yes|no|required|optional|string|str|text|bytes|int|integer|number|object|any|bool|boolean|empty|missing|invalid|expired)$"
    r"|^\W{1,2}$|^[$%]?[{(<\[]|^\$[A-Z_]+$|[A-Za-z_\])]\(|^(?:os|process|self|this|config|settings|env|request|req|args|options)\."
)
SURE_VALUE = r"^(?!.*://)(?=.*[A-Za-z])(?=.*[0-9!@#%^&*?~])\S{6,}$"
PROSE_VALUE = r"^[A-Za-z]?[a-z]*$"
NO_KEY_FORM = r"(?i)^(?:[0-9+/_=-]+|[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})$"
NO_KEY_BEFORE = r"(?i)(?:(?:sha-?(?:1|256|512)|md5|commit|checksum|digest|etag|uuid|revision|hash)\W{0,4}|://\S*)$"
PATH_FORM = r"^/{0,2}[A-Za-z]{2,}(?:[/_-][A-Za-z]{2,})+"
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|your[_-]|x{6,}|0123456789|1234567890|abcdefgh|(.)\1{7,}"
KEY_WORDS = r"(?i)password|passwd|pwd|secret|token|api|key|auth|credential|bearer|login|private"
PLAIN_WORDS = r"(?i)sha|md5|commit|checksum|digest|uuid|hash|version|order|invoice|card|account|phone|number|isbn|serial|id\b"
DICTIONARY = (
    "about access account action after again also and any app are array back base before block build button byte call case change char check child "
    "class click client close code color column common config content control copy count create current data date default delete device div document "
    "down edit element email empty error event example false field file filter find first font for form format from function get global group handle "
    "have header height home host http image index info init input insert item key label last left length level like line link list load local log "
    "main make map max media menu message method min mode model module name new next node not null number object offset one only open option order "
    "other page panel parent path place point post print public query read record region remove request reset result return right role root row run "
    "save scale scroll search select send server service session set show side size sort source start state status step stop string style submit "
    "switch table tag target task template test text that the this time title top total true type under unit update url use user value view vue "
    "web when width will window with word work write www year you"
).split()

CLASSES = "vcuds"  # vowel, consonant, upper case, digit, sign


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, start, stop (characters), match, before, after: every candidate of every text."""
    both = F.array(*[find_all(text_or_empty(), F.lit(p), CONTEXT) for p in (CANDIDATE, VALUE)])
    found = docs.select("doc_id", F.posexplode(both).alias("by_", "f"))
    found = found.select("doc_id", "by_", F.explode("f").alias("f")).select("doc_id", "by_", "f.*")
    # Of a match of VALUE the value alone: without the name, the quotes and, where none opened, marks that close a sentence or a bracket.
    by_value = F.col("by_") == 1
    lead = F.when(by_value, F.regexp_extract("match", f"^{ASSIGN}[\"'`]?", 0)).otherwise("")
    rest = F.expr("substring(match, length(lead_) + 1)")
    bare = F.when(F.col("lead_").rlike("[\"'`]$"), F.regexp_replace(rest, "[\"'`]$", "")).otherwise(F.regexp_replace(rest, r"[.,;)\]}>]++$", ""))
    found = found.withColumn("lead_", lead).withColumn("value_", F.when(by_value, bare).otherwise(F.col("match")))
    start = F.col("start") + F.length("lead_")
    out = found.select(
        "doc_id",
        start.alias("start"),
        (start + F.length("value_")).alias("stop"),
        F.col("value_").alias("match"),
        F.right(F.concat("before", "lead_"), F.lit(CONTEXT)).alias("before"),
        F.left(F.concat(F.expr("substring(match, length(lead_) + length(value_) + 1)"), "after"), F.lit(CONTEXT)).alias("after"),
        by_value.alias("by_value_"),
    )
    # What CANDIDATE finds just so is not found twice.
    run = F.col("match").rlike(f"^{CANDIDATE}$") & ~F.col("before").rlike(f"{RUN}$") & ~F.col("after").rlike(f"^(?:{RUN}|=)")
    return out.filter(~F.col("by_value_") | ((F.col("match") != "") & ~run)).drop("by_value_")


def _classes(text: Column) -> Column:
    """The text with each character replaced by the letter of its class."""
    marks = ["v" if c in "aeiou" else "c" for c in ascii_lowercase] + ["u"] * 26 + ["d"] * 10
    return F.regexp_replace(F.translate(text, ascii_lowercase + ascii_uppercase + digits, "".join(marks)), "[^vcud]", "s")


def features(findings: DataFrame) -> DataFrame:
    """The findings with their numeric features in columns ``x_*``."""
    match = F.col("match")
    size = F.length(match).cast("double")
    rows = findings.withColumn("classes_", _classes(match))
    pairs = lambda a, b: F.regexp_count("classes_", F.lit(f"{a}(?={b})"))
    letters = F.regexp_replace(match, "[^A-Za-z]", "")
    uncovered = F.regexp_replace(F.lower(match), "|".join(sorted((w for w in DICTIONARY if len(w) > 2), key=lambda w: (-len(w), w))), "")
    runs = F.length(F.regexp_replace("classes_", r"(.)\1+", "$1"))
    distinct = F.size(F.array_distinct(F.split(match, "")))
    share = lambda pattern: F.regexp_count(match, F.lit(pattern)) / size
    yes = lambda condition: F.when(condition, 1.0).otherwise(0.0)
    columns = {
        "x_length": F.length("match").cast("double"),
        "x_distinct": distinct / size,
        "x_changes": (runs - 1) / size,
        "x_digits": share("[0-9]"),
        "x_upper": share("[A-Z]"),
        "x_signs": share("[^A-Za-z0-9]"),
        "x_hex": yes(F.col("match").rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
        "x_dictionary": (size - F.length(uncovered)) / size,
        "x_letters": F.length(letters) / size,
        "x_slashes": share("/"),
        "x_in_path": yes(F.col("before").rlike(r"[/\\.]$") | F.col("after").rlike(r"^[/\\.][A-Za-z]")),
        "x_assigned": yes(F.col("before").rlike(r"[=:]\s*[\"'`]?$")),
        "x_quoted": yes(F.col("before").rlike(r"[\"'`]$") & F.col("after").rlike(r"^[\"'`]")),
        "x_key_words": F.regexp_count("before", F.lit(KEY_WORDS)).cast("double"),
        "x_plain_words": F.regexp_count("before", F.lit(PLAIN_WORDS)).cast("double"),
    }
    for a in CLASSES:
        for b in CLASSES:
            columns[f"x_{a}{b}"] = pairs(a, b) / size
    return rows.withColumns(columns).drop("classes_")


def feature_names(featured: DataFrame) -> list[str]:
    return [c for c in featured.columns if c.startswith("x_")]


def rule_name() -> Column:
    """Which rule a finding falls under."""
    name = F.when(F.col("before").rlike(ASSIGNED), "assigned-value").otherwise("generic")
    for vendor, form in VENDOR_KEYS.items():
        name = F.when(F.col("match").rlike(form), vendor).otherwise(name)
    return name


def seed_labels(findings: DataFrame) -> DataFrame:
    """The findings with ``label``: 1.0 secret, 0.0 not, null where form and neighbours don't tell."""
    no_key = F.col("match").rlike(NO_KEY_FORM) | F.col("before").rlike(NO_KEY_BEFORE) | F.col("match").rlike(PLACEHOLDER)
    rule, run, quoted = rule_name(), F.col("match").rlike(f"^{CANDIDATE}$"), F.col("before").rlike("[\"'`]$")
    no_value = F.col("match").rlike(NO_VALUE) | (~quoted & F.col("match").rlike(PROSE_VALUE))
    label = F.when(no_key, 0.0).when(~rule.isin("assigned-value", "generic"), 1.0)
    label = label.when(F.col("match").rlike(PATH_FORM), F.when(~F.col("match").rlike("[!@#%^&*?~]"), 0.0))
    label = label.when(~run & no_value, 0.0).when((rule == "assigned-value") & (run | F.col("match").rlike(SURE_VALUE)), 1.0)
    return findings.withColumn("label", label)


def train(labelled: DataFrame, most: int = MOST_LABELLED) -> PipelineModel | None:
    """A forest from featured findings with ``label`` (0.0 or 1.0); None unless both labels occur."""
    order = [F.xxhash64("match", "before", "after"), F.col("match"), F.col("before"), F.col("after")]
    names = feature_names(labelled)
    labelled = labelled.select("label", "match", "before", "after", *names).distinct()
    parts = [labelled.filter(F.col("label") == v).orderBy(*order).limit(most).select("label", *names) for v in (0.0, 1.0)]
    sample = settle(parts[0].union(parts[1]))
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features_")
    return Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features_"), forest]).fit(sample)


def score(featured: DataFrame, model: PipelineModel | None) -> DataFrame:
    """doc_id, start, stop, match, rule, score, is_secret of every finding."""
    if model is None:
        scored = featured.withColumn("score", F.coalesce("label", F.lit(0.5)))
    else:
        scored = model.transform(featured).withColumn("score", vector_to_array("probability")[1])
    return scored.select(
        "doc_id", "start", "stop", "match", rule_name().alias("rule"), "score", (F.col("score") >= THRESHOLD).alias("is_secret")
    )


def scan(docs: DataFrame) -> DataFrame:
    """All candidates of ``docs`` scored by a forest that learned from the seed labels among them."""
    featured = settle(features(seed_labels(candidates(docs))))
    return score(featured, train(featured.filter("label IS NOT NULL")))
