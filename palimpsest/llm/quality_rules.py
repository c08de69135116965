"""Quality rules: simple counts of a text, and a hashed n-gram log-likelihood ratio.

Everything is DataFrame expressions.  A text is read as units (runs of letters, of digits, or of
other characters) and hashed into ``buckets`` by unit and by pair of neighbouring units.  Two
multinomials over the buckets are counted: of the raw corpus (all documents) and of the trusted
target (documents labelled as good).  A document's score is the sum over its n-grams of
log(target / raw), divided by their number; it passes if the score reaches the threshold.  The
same threshold holds for every document, whatever the corpus.

The counts are combined before they are shuffled, ``buckets`` rows from each task at most.  The
weights, one number for each bucket, come back as a scalar subquery.  All trusted rows count for
the target: to be marked, texts are dealt out once by id, which is smaller than moving their
n-grams, and joined with the ids of the trusted rows; a hot id is left to the skew join.

Defined results: a null or empty text has no words, all its counts are 0 and it fails the base
rules; a text without n-grams has score 0; every row is judged, repeated or without an id; an
id that is labelled several times is trusted if all its labels are good; an empty table gives
an empty one; without trusted rows all scores are 0; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
UNIT = r"\p{L}+|\p{N}+|[^\p{L}\p{N}\s]+"


def _bind(value: Column, function) -> Column:
    """``function(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), function)[0]


def repeat_words(words: Column) -> Column:
    """How many words lie in a window of three words that the text holds twice or more?"""

    def window(i):
        return F.struct(F.xxhash64(words[i], words[i + 1], words[i + 2]).alias("h"), i.alias("i"))

    def repeated(windows):
        def twin(x, i):
            before = F.when(i > 0, F.get(windows, i - 1)["h"])
            return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(
                x["h"] == F.get(windows, i + 1)["h"], F.lit(False)
            )

        return F.transform(F.filter(windows, twin), lambda x: x["i"])

    def covered(starts):
        return F.size(F.array_union(F.array_union(starts, F.transform(starts, lambda i: i + 1)), F.transform(starts, lambda i: i + 2)))

    windows = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - 3), window))
    return F.when(F.size(words) > 3, _bind(_bind(windows, repeated), covered)).otherwise(0)


def base_counts(text: Column) -> Column:
    """A struct of the counts that the base rules judge, and their verdict."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    symbols = F.length(F.array_join(F.regexp_extract_all(text, F.lit(SYMBOLS), F.lit(0)), ""))

    def counts(words):
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            _bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeat_words(words).cast("long").alias("n_repeat_words"),
        )

    def judged(c):
        failed = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
        return F.struct(*(c[name].alias(name) for name in COUNTS), failed.alias("base_failed"))

    return _bind(_bind(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), counts), judged)


def grams(text: Column, buckets: int) -> Column:
    """Buckets of a text's units and of pairs of neighbouring units."""

    def hashed(units):
        pairs = F.zip_with(
            F.slice(units, 1, F.greatest(F.size(units) - 1, F.lit(0))),
            F.slice(units, 2, F.greatest(F.size(units) - 1, F.lit(0))),
            lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int"),
        )
        return F.concat(F.transform(units, lambda u: F.pmod(F.xxhash64(u), F.lit(buckets)).cast("int")), pairs)

    return _bind(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNIT), F.lit(0)), hashed)


def trusted(labels: DataFrame) -> DataFrame:
    """Ids whose labels all say good."""
    good = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return good.filter("quality = 1").select("doc_id")


def weights(docs: DataFrame, labels: DataFrame, buckets: int, smoothing: float) -> DataFrame:
    """One row: the array of log(target / raw) for all buckets."""
    known = trusted(labels).withColumn("target", F.lit(1))
    # A hash table of ids for each part: texts are dealt out by id, but not sorted.
    named = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    marked = named.join(known.hint("shuffle_hash"), "doc_id", "left").select("target", "text")
    others = docs.filter("doc_id IS NULL").select(F.lit(None).cast("int").alias("target"), "text")
    rows = marked.unionByName(others).select("target", grams(F.col("text"), buckets).alias("grams"))
    counts = (
        rows.select("target", F.explode_outer("grams").alias("bucket"))
        .filter("bucket IS NOT NULL")
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count("target").alias("target"))
    )
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    dense = every.join(counts, "bucket", "left").fillna(0, ["raw", "target"])
    table = dense.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("t"),
        F.sum("raw").alias("all_raw"),
        F.sum("target").alias("all_target"),
    )
    more = smoothing * buckets

    def ratio(x):
        target = (x["target"] + smoothing) / (F.col("all_target") + more)
        return F.log(target) - F.log((x["raw"] + smoothing) / (F.col("all_raw") + more))

    zeros = F.transform("t", lambda x: F.lit(0.0))
    return table.select(F.when(F.col("all_target") > 0, F.transform("t", ratio)).otherwise(zeros).alias("w"))


def judged(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = -0.5,
    buckets: int = 1 << 16,
    smoothing: float = 1.0,
) -> DataFrame:
    """Each input row as ``row``, the base counts as ``base``, ``score`` and ``kept``.

    Every expression stands in the plan once, also where a filter on ``kept`` is pushed down.
    """
    ratios = weights(docs.select("doc_id", "text"), labels, buckets, smoothing)
    rows = docs.select(F.struct("*").alias("row")).withColumn("_w", ratios.scalar())
    text = F.col("row")["text"]

    def score(found):
        total = F.aggregate(found, F.lit(0.0), lambda s, g: s + F.col("_w")[g])
        return F.when(F.size(found) > 0, total / F.size(found)).otherwise(0.0)

    rows = rows.select(
        "row", base_counts(text).alias("base"), _bind(grams(text, buckets), score).alias("score")
    )
    return rows.select(
        "row", "base", "score", (~F.col("base.base_failed") & (F.col("score") >= threshold)).alias("kept")
    )


def quality_rules(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Base counts, ``base_failed``, ``kept`` and ``score`` for every row of ``docs``."""
    rows = judged(docs.select("doc_id", "text"), labels, **options)
    return rows.select("row.doc_id", "base.*", "kept", "score")


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    return judged(docs, labels, **options).filter("kept").select("row.*")
