"""Aggregates and windows: rollups, votes, outliers, samples, latest rows, sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def path_rollup(files: DataFrame, path: str, size: Column) -> DataFrame:
    """Files and bytes below every folder of '/'-separated paths."""
    parts = F.split(path, "/")
    parents = files.select(parts.alias("p"), size.alias("b")).select("b", F.explode(F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.array_join(F.slice("p", F.lit(1), i), "/"))).alias("folder"))
    return parents.groupBy("folder").agg(F.count("*").alias("files"), F.sum("b").alias("bytes"))


def outliers(counts: DataFrame, value: str, by: list[str] | None = None, z: float = 2.0) -> DataFrame:
    """Rows with their population z-score and whether it is beyond z; 0 where there is no spread. The moments are aggregated, then joined."""
    both = F.struct(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"))
    joined = counts.join(counts.groupBy(*by).agg(both.alias("__m")), by) if by else counts.withColumn("__m", counts.agg(both).scalar())
    mean, sd = F.col("__m.mean"), F.coalesce("__m.sd", F.lit(0.0))
    score = F.when(sd == 0, 0.0).otherwise((F.col(value) - mean) / sd)
    return joined.withColumn("z", score).withColumn("outlier", F.abs("z") > z).drop("__m")


def latest(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The row of the greatest order in each key, by a maximum with partial aggregation."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__row")).select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def examples(df: DataFrame, keys: list[str], value: str, most: int, order: list[Column] | None = None) -> DataFrame:
    """Per group (keys) n, its rows, and examples, the first `most` values in order. Ranks are cut in every task before rows travel, so a group is never gathered whole."""
    order = order or [F.col(value).asc_nulls_last()]
    first = top_n(df.where(F.col(value).isNotNull()), keys, order, most).groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", value))), lambda x: x[value]).alias("examples"))
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    on = [counts[k].eqNullSafe(first[k]) for k in keys]
    return counts.join(first, on, "left").select(*[counts[k] for k in keys], "n", F.coalesce("examples", F.array().cast(f"array<{df.schema[value].dataType.simpleString()}>")).alias("examples"))


def weighted_vote(signals: DataFrame, boost: dict[str, float] | None = None, places: int = 6) -> DataFrame:
    """Of (item, signal, weight, confidence, candidate): per item the winners (all ties, sorted), the vote, its share, and a status band.

    Votes are rounded before they are compared, so that the order of a sum can't break a tie.
    """
    factor = F.lit(1.0)
    for s, b in (boost or {}).items():
        factor = F.when(F.col("signal") == s, b).otherwise(factor)
    votes = signals.groupBy("item", "candidate").agg(F.round(F.sum(F.col("weight") * F.col("confidence") * factor), places).alias("vote"))
    w = Window.partitionBy("item")
    ranked = votes.select("*", F.max("vote").over(w).alias("best"), F.sum("vote").over(w).alias("total"))
    out = ranked.where("vote = best").groupBy("item").agg(F.array_sort(F.collect_set("candidate")).alias("winners"), F.first("best").alias("vote"), F.first("total").alias("total"))
    share = F.round(F.when(F.col("total") == 0, 0.0).otherwise(100 * F.col("vote") / F.col("total")), 2)
    return out.select("item", "winners", "vote", share.alias("confidence")).withColumn("status", F.when(F.col("confidence") >= 90, "high").when(F.col("confidence") >= 70, "medium").when(F.col("confidence") >= 50, "low").otherwise("review"))


def document_frequency(df: DataFrame, item: str, words: Column, share: float) -> DataFrame:
    """How many items hold each word, and whether that is more than a share of all."""
    counts = df.select(item, F.explode(F.array_distinct(words)).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    return counts.withColumn("common", F.col("df") > share * df.agg(F.count("*")).scalar())


def set_overlap(df: DataFrame, group: str, member: str) -> DataFrame:
    """Jaccard of the member sets of each two groups, from counts of shared members; groups are few, members may be many."""
    m = df.select(F.col(group).alias("g"), F.col(member).alias("m")).distinct()
    sizes = m.groupBy("g").agg(F.count("*").alias("n"))
    lists = m.groupBy("m").agg(F.array_sort(F.collect_list("g")).alias("gs"))
    pairs = lists.select(F.explode(F.flatten(F.transform("gs", lambda a, i: F.transform(F.slice("gs", i + 2, F.size("gs")), lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("p")).groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.count("*").alias("shared"))
    grid = sizes.select(F.col("g").alias("a"), F.col("n").alias("na")).join(sizes.select(F.col("g").alias("b"), F.col("n").alias("nb")), F.col("a") < F.col("b"))
    return grid.join(pairs, ["a", "b"], "left").select("a", "b", F.coalesce("shared", F.lit(0)).alias("shared"), (F.coalesce("shared", F.lit(0)) / (F.col("na") + F.col("nb") - F.coalesce("shared", F.lit(0)))).alias("jaccard"))


def hash_unit(key: Column, seed: str = "") -> Column:
    """A number in (0, 1] from the first 13 hex digits of md5, the same in every engine."""
    return (F.conv(F.substring(F.md5(F.concat(F.lit(seed), key.cast("string"))), 1, 13), 16, 10).cast("double") + 1) / float(16**13)


def weighted_sample(df: DataFrame, key: str, weight: Column, n: int, stratum: str | None = None, seed: str = "") -> DataFrame:
    """n rows without replacement, likelier by weight; with a stratum, the best of each stratum first (Efraimidis and Spirakis keys)."""
    keyed = df.withColumn("__k", -F.log(hash_unit(F.col(key), seed)) / weight)
    if stratum is None:
        return keyed.orderBy("__k", key).limit(n).drop("__k")
    first = keyed.groupBy(stratum).agg(F.min(F.struct("__k", key)).alias("__f")).select(F.col(f"__f.{key}").alias("__id"))
    flagged = keyed.join(first, F.col(key) == F.col("__id"), "left")
    return flagged.orderBy(F.col("__id").isNull(), "__k", key).limit(n).drop("__k", "__id")


def budget_sample(errors: DataFrame, check: str, severity_rank: Column, key: str, per_check: int, budget: int) -> DataFrame:
    """At most per_check rows of a check, the most severe first, until the budget is spent."""
    w = Window.partitionBy(check).orderBy(key)
    few = errors.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= per_check).withColumn("__s", severity_rank)
    return few.orderBy("__s", check, key).limit(budget).drop("__r", "__s")


def batches(df: DataFrame, order: str, size: int, block: int = 1 << 16) -> DataFrame:
    """Consecutive batch numbers over a whole order, without one task for all rows: ranks inside blocks of an integer order plus the blocks' offsets."""
    b = df.withColumn("__b", F.floor(F.col(order) / block))
    sizes = b.groupBy("__b").agg(F.count("*").alias("__n"))
    before = sizes.withColumn("__o", F.coalesce(F.sum("__n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    place = F.row_number().over(Window.partitionBy("__b").orderBy(order)) + F.col("__o") - 1
    return b.join(before, "__b").withColumn("batch", (F.floor(place / size) + 1).cast("long")).drop("__b", "__o")


def islands(df: DataFrame, keys: list[str], order: str, starts: Column) -> DataFrame:
    """Number of the section that each row is in: how many starting rows came so far in its key."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("section", F.sum(starts.cast("int")).over(w))


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def heading_sections(rows: DataFrame, key: str, order: str, line: str, pattern: str) -> DataFrame:
    """Sections under headings: text before the first one is _preamble; a heading that comes again keeps its last body."""
    marked = islands(rows, [key], order, F.col(line).rlike(pattern))
    body = marked.groupBy(key, "section").agg(F.max(F.when(F.col(line).rlike(pattern), F.regexp_replace(line, pattern, ""))).alias("h"), F.array_sort(F.collect_list(F.when(~F.col(line).rlike(pattern), F.struct(order, line)))).alias("b"))
    named = body.select(key, "section", F.coalesce(F.trim("h"), F.lit("_preamble")).alias("heading"), F.trim(F.array_join(F.transform("b", lambda x: x[line]), "\n")).alias("body"))
    return named.groupBy(key, "heading").agg(F.max_by("body", "section").alias("body"))


def consensus(verdicts: DataFrame) -> DataFrame:
    """Of (record, attempt, field, verdict): per record and field the majority (ties: the earliest), whether all agree, and the votes."""
    n = verdicts.groupBy("record", "field", "verdict").agg(F.count("*").alias("n"), F.min("attempt").alias("at"))
    best = n.groupBy("record", "field").agg(F.min(F.struct((-F.col("n")).alias("n"), "at", "verdict")).alias("x"), F.count("*").alias("kinds"), F.sum("n").alias("votes"))
    return best.select("record", "field", F.col("x.verdict").alias("verdict"), (F.col("kinds") == 1).alias("unanimous"), "votes")


def merged_annotations(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Two annotators' rows (key, tags, description): tags united, the longer description, and who was there."""
    x, y = a.select(key, F.col("tags").alias("ta"), F.col("description").alias("da")), b.select(key, F.col("tags").alias("tb"), F.col("description").alias("db"))
    none = F.array().cast("array<string>")
    longer = F.when(F.coalesce(F.length("db"), F.lit(0)) > F.coalesce(F.length("da"), F.lit(0)), F.col("db")).otherwise(F.col("da"))
    who = F.when(F.col("da").isNotNull() & F.col("db").isNotNull(), "high").otherwise("single")
    return x.join(y, key, "full_outer").select(key, F.array_union(F.coalesce("ta", none), F.coalesce("tb", none)).alias("tags"), longer.alias("description"), who.alias("confidence"))
