"""Secret scans whose false positives a random forest removes; DataFrame functions and Spark ML only.

A candidate is a run of at least ``MIN_LENGTH`` letters, digits and ``+/_=.-`` in a text. Its features
are its length and kinds of characters, how likely its character transitions are among the corpus's
own words, how much of it dictionary words cover, the path of its document, and the words around it.
The dictionary (the corpus's commonest words) and the transitions are counted over all documents. The
forest is trained on labelled findings and scores every candidate.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Scratch
from millrace.lookup import lookup_join

MIN_LENGTH = 16
DICTIONARY_WORDS = 5000
WORD_LENGTHS = (3, 10)
# The forest is fitted on at most so many findings of each label.
MAX_LABELLED = 10_000
TREES, DEPTH = 24, 6
SEED = 7
# Names that secrets are given, and parts of paths where they are made up.
SECRET_NAMES = r"(?i)(token|secret|passw|passwd|pwd|api.?key|access.?key|auth|credential|private)"
SAMPLE_PATHS = r"(?i)(test|mock|example|sample|fixture|doc|vendor)"
# Shapes that keys of well-known makers and signed tokens have.
KEY_SHAPES = (
    r"^(AKIA|ASIA)[0-9A-Z]{16}$",
    r"^gh[pousr]_[A-Za-z0-9]{36,}$",
    r"^(sk|pk|rk)_(live|test)_[A-Za-z0-9]{16,}$",
    r"^xox[abprs]-[A-Za-z0-9-]{10,}$",
    r"^AIza[A-Za-z0-9_-]{35}$",
    r"^eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*$",
)
# A text of letters or dotted parts counts as made of words from this share of dictionary words on.
WORDY = 0.5
CORE = r"[A-Za-z0-9+/_=.\-]{%d,}"
UNSEEN = -9.0

FEATURES = [
    "length", "digits", "upper", "lower", "switches", "variety", "transitions", "coverage", "assigned",
    "named", "quoted", "common_before", "common_after", "path_depth", "path_sample",
]


def _share(value: Column, kind: str) -> Column:
    return F.regexp_count(value, F.lit(kind)) / F.length(value)


def findings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """``(doc, path, word, place, value, before, name, after, quoted)`` per candidate.

    ``word`` numbers the words of the text from 0 and ``place`` the candidates within a word; one or
    two words before and one after it come along.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    words = docs.select(F.col(id_col).cast("long").alias("doc"), path.alias("path"), F.split(text, r"\s+").alias("words"))
    long = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.length(F.get("words", i)) >= MIN_LENGTH)
    at = words.select("doc", "path", "words", F.explode(long).alias("word"))
    near = at.select(
        "doc",
        "path",
        "word",
        F.get("words", F.col("word")).alias("whole"),
        *[F.coalesce(F.get("words", F.col("word") + d), F.lit("")).alias(n) for n, d in (("name", -2), ("before", -1), ("after", 1))],
    )
    core = CORE % MIN_LENGTH
    found = near.select("*", F.posexplode(F.regexp_extract_all("whole", F.lit(f"({core})"), 1)).alias("place", "value"))
    quoted = F.col("whole").rlike("^[\"'`]") & F.col("whole").rlike("[\"'`]\\W*$")
    return found.select("doc", "path", "word", "place", "value", "whole", "name", "before", "after", quoted.alias("quoted"))


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, n)``: words of letters in lower case, counted over all texts."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = docs.select(F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word"))
    return words.filter(F.col("word") != "").groupBy("word").agg(F.count("*").alias("n"))


def dictionary(counts: DataFrame, size: int = DICTIONARY_WORDS) -> DataFrame:
    """``(word, rank)`` of the commonest words long enough to cover part of a candidate."""
    low, high = WORD_LENGTHS
    common = counts.filter(F.length("word").between(low, high)).orderBy(F.desc("n"), "word").limit(size)
    return common.select("word", F.log1p("n").alias("weight"))


def transitions(counts: DataFrame) -> DataFrame:
    """``(pair, likely)``: log likelihood of a letter after another in the corpus's words.

    Letters beyond a to z count as one, so there are at most 27 * 27 rows.
    """
    pairs = _pairs(counts.select("n", F.regexp_replace("word", "[^a-z]", "~").alias("letters")), "n", "letters")
    known = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    of_first = F.sum("n").over(Window.partitionBy(F.substring("pair", 1, 1)))  # 27 groups of 27 rows
    return known.select("pair", F.log(F.col("n") / of_first).alias("likely"))


def _pairs(df: DataFrame, keep: str, letters: str) -> DataFrame:
    """A row per letter and the one after it. Letters are looked up in an array, so the work is linear."""
    some = df.filter(F.length(letters) > 1).select(keep, F.split(letters, "").alias("chars"))
    at = F.sequence(F.lit(1), F.size("chars") - 1)
    both = F.transform(at, lambda i: F.concat(F.get("chars", i - 1), F.get("chars", i)))
    return some.select(keep, F.explode(both).alias("pair")).filter(F.length("pair") == 2)


def _of_values(values: DataFrame, words: DataFrame, likely: DataFrame) -> DataFrame:
    """``(value, transitions, coverage)`` per distinct candidate; both tables are small by their bounds.

    Rows per letter carry a value's 64-bit hash and not the value, and at most the longest word's letters,
    so the work is linear in a candidate's length.
    """
    known = values.withColumn("vid", F.xxhash64("value"))
    shown = known.select("vid", F.regexp_replace(F.lower("value"), "[^a-z0-9]", "~").alias("letters"))
    pairs = _pairs(shown, "vid", "letters").join(F.broadcast(likely), "pair", "left")
    mean = pairs.groupBy("vid").agg(F.avg(F.coalesce("likely", F.lit(UNSEEN))).alias("transitions"))
    low, high = WORD_LENGTHS
    chars = shown.select("vid", F.split("letters", "").alias("chars"))
    ahead = F.transform(F.sequence(F.lit(1), F.size("chars")), lambda i: F.array_join(F.slice("chars", i, high), ""))
    starts = chars.select("vid", F.posexplode(ahead).alias("start", "ahead"))
    starts = starts.select("vid", "start", F.regexp_extract("ahead", "^[a-z]+", 0).alias("ahead")).filter(F.length("ahead") >= low)
    parts = starts.select("vid", "start", "ahead", F.explode(F.sequence(F.lit(low), F.length("ahead"))).alias("size"))
    parts = parts.select("vid", "start", "size", F.expr("substr(ahead, 1, size)").alias("word"))
    hit = parts.join(F.broadcast(words.select("word")), "word")
    covered = hit.select("vid", F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("at")).distinct()
    covered = covered.groupBy("vid").agg(F.count("*").alias("covered"))
    both = known.join(mean, "vid", "left").join(covered, "vid", "left")
    share = F.coalesce("covered", F.lit(0)) / F.length("value")
    return both.select("value", F.coalesce("transitions", F.lit(UNSEEN)).alias("transitions"), share.alias("coverage"))


def with_features(found: DataFrame, words: DataFrame, likely: DataFrame) -> DataFrame:
    """``found`` with the columns ``FEATURES``. A value's own features are worked out once per value."""
    scratch = Scratch(found.sparkSession, "secrets")
    per_value = scratch.keep(_of_values(found.select("value").distinct(), words, likely))
    value, before = F.col("value"), F.concat_ws(" ", "name", "before")
    bare = [F.lower(F.regexp_replace(c, r"[^\p{L}]", "")) for c in ("before", "after")]
    joined = lookup_join(found, per_value, "value")
    for name, word in (("common_before", bare[0]), ("common_after", bare[1])):
        joined = joined.withColumn("bare", word).join(F.broadcast(words.select(F.col("word").alias("bare"), F.col("weight").alias(name))), "bare", "left")
    path = F.coalesce("path", F.lit(""))
    whole = F.col("whole")
    features = {
        "length": F.length(value).cast("double"),
        "digits": _share(value, "[0-9]"),
        "upper": _share(value, "[A-Z]"),
        "lower": _share(value, "[a-z]"),
        "switches": _share(value, "(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]|(?<=[a-z])[A-Z]"),
        "variety": F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
        "transitions": F.col("transitions"),
        "coverage": F.col("coverage"),
        "assigned": (F.col("before").rlike("[=:]$") | whole.rlike("^[^=:]{1,64}[=:][\"'`]?")).cast("double"),
        "named": (before.rlike(SECRET_NAMES) | F.substring_index(whole, "=", 1).rlike(SECRET_NAMES)).cast("double"),
        "quoted": F.col("quoted").cast("double"),
        "common_before": F.coalesce("common_before", F.lit(0.0)),
        "common_after": F.coalesce("common_after", F.lit(0.0)),
        "path_depth": F.regexp_count(path, F.lit("/")).cast("double"),
        "path_sample": path.rlike(SAMPLE_PATHS).cast("double"),
    }
    own = ["doc", "path", "word", "place", "value", "whole", "name", "before", "after"]
    return joined.select(*own, *[features[f].alias(f) for f in FEATURES])


def seed_labels(featured: DataFrame) -> DataFrame:
    """Adds ``label``: 1 and 0 for findings that their form alone settles, null for the others.

    1: a known key shape; or quoted, assigned to a secret's name and either 32 hexadecimal digits or more
    with digits and letters mixed, or 24 characters or more with digits, capitals and small letters mixed
    and few dictionary words. 0: digits only; at most three different characters; letters only or dotted parts (hosts and files), as far as
    dictionary words cover half of them. Letters that no words cover, dotted parts of that kind and all
    else have no label. These stand in for findings labelled by hand, which ``train`` takes just the same.
    """
    value = F.col("value")
    shaped = F.lit(False)
    for pattern in KEY_SHAPES:
        shaped = shaped | value.rlike(pattern)
    has = lambda pattern: value.rlike(pattern)
    hex_digits = has("^[0-9A-Fa-f]{32,}$") & has("[0-9]") & has("[A-Fa-f]")
    mixed = has(r"^[A-Za-z0-9+/_=\-]{24,}$") & has("[0-9]") & has("[A-Z]") & has("[a-z]") & (F.col("coverage") < WORDY)
    said = (F.col("quoted") == 1) & (F.col("assigned") == 1) & (F.col("named") == 1)
    dotted = has("^[A-Za-z]+$") | has(r"^[A-Za-z0-9_\-]+(\.[A-Za-z0-9_\-]+)+\.?$")
    rule = F.col("variety") * F.col("length") < 3.5  # a ruler or filler of up to three characters
    clear = has("^[0-9]+$") | rule | (dotted & (F.col("coverage") >= WORDY))
    return featured.withColumn("label", F.when(shaped | (said & (hex_digits | mixed)), 1).when(clear, 0))


def train(labelled: DataFrame, max_labelled: int = MAX_LABELLED):
    """Forest from findings with ``FEATURES`` and ``label``, or a constant where one label is missing.

    Per label the ``max_labelled`` findings with the smallest hash are used; rows without a label
    are ignored.
    """
    own = [F.xxhash64("value", "doc", "word", "place").alias("hash"), "label", *FEATURES]
    some = labelled.filter("label IS NOT NULL").select(*own)
    parts = [some.filter(F.col("label") == y).orderBy("hash").limit(max_labelled) for y in (0, 1)]
    chosen = Scratch(labelled.sparkSession, "labelled").keep(parts[0].union(parts[1]))
    counts = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    if len(counts) < 2:
        return float(1 in counts) if counts else 0.5
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="vector", labelCol="label")
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(chosen))


def scored(featured: DataFrame, model) -> DataFrame:
    """Adds ``score``, the forest's probability that a finding is a secret."""
    if isinstance(model, float):
        return featured.withColumn("score", F.lit(model))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(featured)
    share = vector_to_array(F.col("probability"))[1]
    return model.transform(vectors).withColumn("score", share).drop("vector", "rawPrediction", "probability", "prediction")


def scan(
    docs: DataFrame,
    labelled=None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str | None = "source",
    threshold: float = 0.5,
) -> DataFrame:
    """``(doc, word, place, value, score, kept)`` for every candidate in whole texts.

    ``kept`` is whether the score reaches ``threshold``; the others are the false positives removed.
    ``labelled`` maps a frame of findings with features to one with ``label`` (default:
    ``seed_labels``). Null text is empty; a null path counts as none; null ids are kept; rows that
    repeat are scanned as often as they occur; an empty table gives no findings. Other columns are
    ignored. Without findings of both labels every score is the share of label 1 (0.5 without any).
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    found = scratch.keep(findings(docs, id_col=id_col, text_col=text_col, path_col=path_col))
    counts = scratch.keep(word_counts(docs, text_col))
    words, likely = scratch.keep(dictionary(counts)), scratch.keep(transitions(counts))
    featured = scratch.keep(with_features(found, words, likely))
    model = train((labelled or seed_labels)(featured))
    rated = scored(featured, model)
    return rated.select("doc", "word", "place", "value", "score", (F.col("score") >= threshold).alias("kept"))
