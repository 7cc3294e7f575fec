"""Operator 1. Quality rules: base counts, and a hashed n-gram log-likelihood ratio between a trusted target and the corpus.

Every document becomes hashed one- and two-word features in `buckets` buckets. Two multinomials are counted over whole
tables: the trusted target (documents labelled of good quality) and the raw corpus (all documents). A document's score is
the mean over its features of ln(p_target / p_raw), where the target is smoothed towards the raw distribution by a weight of
`smoothing` in each bucket, so that rare features say little; documents under `threshold` are rejected. Only DataFrame functions.

Defined results: a null text is empty; a text without words has score 0, and fails the base rule on length; equal rows give
equal results, one row each; an empty documents table gives no rows; without trusted documents all ratios are 0 and only the
base rules decide; labels with a null or repeated doc_id count once, the largest quality wins; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words_of

BUCKETS = 1 << 16
SMOOTHING = 10.0
THRESHOLD = -0.1
MIN_WORDS = 50


def features(words: Column, buckets: int = BUCKETS) -> Column:
    """Bucket numbers of all words and of all pairs of neighbours (the last word pairs with the end)."""
    one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    two = let(words, lambda ws: F.zip_with(ws, F.slice(ws, F.lit(2), F.size(ws)), lambda a, b: F.pmod(F.xxhash64(F.lit(2), a, F.coalesce(b, F.lit(" "))), F.lit(buckets)).cast("int")))
    return F.concat(one, two)


def repeated_words(words: Column) -> Column:
    """Number of words inside three-word windows that occur at least twice in the text."""

    def windows(ws: Column) -> Column:
        return F.transform(F.slice(ws, F.lit(1), F.greatest(F.size(ws) - 2, F.lit(0))), lambda a, i: F.xxhash64(a, F.element_at(ws, i + 2), F.element_at(ws, i + 3)))

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(pairs, lambda p: F.filter(p, lambda x, i: ((i > 0) & (F.try_element_at(p, F.greatest(i, F.lit(1)))["h"] == x["h"])) | F.coalesce(F.try_element_at(p, i + 2)["h"] == x["h"], F.lit(False))))
        return F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    hashes = let(words, windows)
    return let(hashes, lambda hs: F.when(F.size(hs) == F.size(F.array_distinct(hs)), F.lit(0)).otherwise(covered(hs)))


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """One row: `ratios`, ln(p_target / p_raw) of each bucket in order. Counts take in all documents and all labels."""
    trusted = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("q")).where("q = 1").select("doc_id", F.lit(1).alias("trusted"))
    trusted = trusted.hint("merge")  # labels grow with the documents, so they are never broadcast
    marked = docs.select("doc_id", "text").join(trusted, "doc_id", "left").select(F.coalesce("trusted", F.lit(0)).alias("trusted"), words_of(F.col("text")).alias("words"))
    counts = marked.select("trusted", F.explode(features(F.col("words"), buckets)).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("target"))
    ordered = F.array_sort(F.collect_list(F.struct("bucket", "raw", "target")))
    spark = docs.sparkSession
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").select("bucket", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
    totals = every.agg(ordered.alias("c"), F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target"))
    share = F.col("n_target") / F.col("n_raw")
    ratio = lambda x: F.log((x["target"] + smoothing) / (x["raw"] * share + smoothing))
    return totals.select(F.when(F.col("n_target") > 0, F.transform("c", ratio)).otherwise(F.transform("c", lambda x: F.lit(0.0))).alias("ratios"))


def quality_rules(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, base counts, base_failed, llr (mean log-likelihood ratio) and kept of every document."""
    ratios = log_ratios(docs, labels, buckets).scalar()
    w = F.col("words")
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", "text", words_of(F.col("text")).alias("words"), ratios.alias("ratios"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = base.select(
        "doc_id",
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.when(F.contains("text", F.lit("\n")), let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))).otherwise(0).cast("long").alias("n_dup_lines"),
        repeated_words(w).cast("long").alias("n_repeat_words"),
        let(F.col("ratios"), lambda r: F.aggregate(features(w, buckets), F.lit(0.0), lambda s, b: s + F.element_at(r, b + 1))).alias("total"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    llr = F.when(F.col("n_words") > 0, F.col("total") / (2 * F.col("n_words"))).otherwise(0.0)
    return counted.select("*", failed.alias("base_failed"), llr.alias("llr")).select("*", (~F.col("base_failed") & (F.col("llr") >= threshold)).alias("kept")).drop("total")
