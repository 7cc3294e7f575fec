"""Operator 4. Benchmark decontamination: a broadcast hash set of the benchmark's word n-grams against all document windows.

Texts are lower-cased in A-Z only and cut into words. Each distinct window of `width` item words (or the whole item, if it is
shorter) is one gram, kept in a hash table under the hash of its longest word. Every word of every document looks up its hash; where it meets
the anchor of a gram, the window around it is compared word by word with the gram. Grams are broadcast only while there are at
most `broadcast_grams`; beyond that Spark joins by shuffle on the anchor. Only DataFrame functions.

Defined results: null texts have no words and no windows; items without words match nothing; a gram in several items counts for
all of them; equal documents have equal results, one row each, and null doc_ids are kept; empty tables give zero counts or
no rows; item_ids are compared and listed as strings, null item_ids are left out of the list; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, digest, fresh, let

WIDTH = 10
BROADCAST_GRAMS = 1_000_000
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def item_words(text: Column) -> Column:
    """Words of the text, A-Z lower-cased and other letters as they are; null gives none."""
    text = F.coalesce(text, F.lit(""))
    folded = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.regexp_extract_all(folded, F.lit(WORD), F.lit(0))


def grams_of(benchmark: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (anchor, off, n, gram, gram_key) and which items have them (gram_key, item_id as a string).

    The anchor is the hash of the window's longest word (the first of equals), which is rare in texts; off is its place in the window.
    """
    windows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), item_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    each = windows.select("item_id", F.explode(let(F.col("w"), lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - width + 1, F.lit(1))), lambda i: F.slice(w, i, F.lit(width))))).alias("gram")).distinct()
    keyed = each.select("item_id", "gram", F.unhex(F.md5(F.array_join("gram", " "))).alias("gram_key"))
    longest = F.array_max(F.transform("gram", lambda w, i: F.struct(F.length(w).alias("size"), (-i).alias("off"), w.alias("word"))))
    grams = keyed.select("gram_key", "gram").distinct().select("gram_key", "gram", F.size("gram").alias("n"), longest.alias("a"))
    return grams.select(F.xxhash64("a.word").alias("anchor"), (-F.col("a.off")).alias("off"), "n", "gram", "gram_key"), keyed.where("item_id is not null").select("gram_key", "item_id")


def spots(rows: DataFrame, grams: DataFrame, few: bool) -> DataFrame:
    """Of rows (doc_id, row_key, words): (doc_id, row_key, at, n, gram_key) of each occurrence of a gram, at counting words from 0; and
    one row of each input row with n = 0 and at = its number of words."""
    end = F.concat("words", F.array(F.lit("")))  # words are never empty, so the empty string marks the end
    exploded = rows.select("doc_id", "row_key", end.alias("words")).select("doc_id", "row_key", "words", F.posexplode("words").alias("i", "w"))
    marker = rows.sparkSession.range(1).select(F.xxhash64(F.lit("")).alias("anchor"), F.lit(0).alias("off"), F.lit(0).alias("n"), F.array().cast("array<string>").alias("gram"), F.lit(None).cast("binary").alias("gram_key"))
    wanted = grams.select("anchor", "off", "n", "gram", "gram_key").union(marker)
    if few:
        near, at = exploded.select("doc_id", "row_key", "i", F.xxhash64("w").alias("anchor"), "words"), F.col("i") - F.col("off") + 1
        wanted = F.broadcast(wanted)
    else:  # the words that travel are those around the anchor only
        from_ = F.greatest(F.col("i") - WIDTH + 2, F.lit(1))
        near = exploded.select("doc_id", "row_key", "i", F.xxhash64("w").alias("anchor"), from_.alias("from"), F.slice("words", from_, F.lit(2 * WIDTH)).alias("words"))
        at = F.col("i") - F.col("off") + 2 - F.col("from")
    same = (F.col("n") == 0) | ((at >= 1) & (F.slice("words", F.greatest(at, F.lit(1)), F.col("n")) == F.col("gram")))
    return near.join(wanted, "anchor").where(same).select("doc_id", "row_key", (F.col("i") - F.col("off")).alias("at"), "n", "gram_key")


def occurrences(docs: DataFrame, grams: DataFrame, broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """Per different (doc_id, row_key): n_rows with these values, n_words, n_hit and gram_keys."""
    few = grams.limit(broadcast_grams + 1).count() <= broadcast_grams
    rows = docs.select("doc_id", digest(F.col("text")).alias("row_key"), item_words(F.col("text")).alias("words"))
    hit = F.when(F.col("n") > 0, F.sequence(F.col("at"), F.col("at") + F.col("n") - 1))
    found = spots(rows, grams, few).groupBy("doc_id", "row_key").agg(F.count_if(F.col("n") == 0).alias("n_rows"), F.max(F.when(F.col("n") == 0, F.col("at"))).cast("long").alias("n_words"), F.collect_set(hit).alias("hit"), F.collect_set("gram_key").alias("gram_keys"))
    return found.select("doc_id", "row_key", "n_rows", "n_words", F.size(F.array_distinct(F.flatten("hit"))).cast("long").alias("n_hit"), "gram_keys")


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    grams, items = grams_of(benchmark, width)
    found = cut_lineage(occurrences(docs, grams, broadcast_grams))
    which = found.where("n_hit > 0").select("doc_id", "row_key", F.explode("gram_keys").alias("gram_key")).join(items, "gram_key").select("doc_id", "row_key", "item_id").distinct()
    which = which.groupBy("row_key", F.col("doc_id").alias("id")).agg(F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("items"), F.count("*").alias("n_items"))
    out = found.join(which, (found["row_key"] == which["row_key"]) & found["doc_id"].eqNullSafe(which["id"]), "left").select("doc_id", "n_rows", "n_words", "n_hit", "items", "n_items")
    each = out.select("*", F.explode(F.array_repeat(F.lit(0), F.col("n_rows").cast("int"))).alias("row"))
    return each.select("doc_id", "n_words", "n_hit", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """The documents, with all their columns, in which no benchmark window occurs; null texts stay."""
    grams, _ = grams_of(benchmark, width)
    key, hit_key, hit_id = (fresh(docs.columns, x) for x in ("key_", "hit_key_", "hit_id_"))
    found = occurrences(docs.select("doc_id", "text"), grams, broadcast_grams).where("n_hit > 0").select(F.col("row_key").alias(hit_key), F.col("doc_id").alias(hit_id))
    keyed = docs.withColumn(key, digest(F.col("text")))
    return keyed.join(found, (F.col(key) == F.col(hit_key)) & F.col("doc_id").eqNullSafe(F.col(hit_id)), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
