"""Lookups, exclusions and tallies that reports are made of: each one join or one aggregate over columns that the caller names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cascade_lookup(items: DataFrame, table: DataFrame, keys: list[str], value: str) -> DataFrame:
    """items with `found` and `how`: the least value of the first key, in this order, under which the table knows the item. One reduced join for each key."""
    out = items
    for k in keys:
        known = table.where(F.col(k).isNotNull()).groupBy(F.col(k).alias(f"{k}_of")).agg(F.min(value).alias(f"by_{k}"))
        out = out.join(known, F.col(k) == F.col(f"{k}_of"), "left").drop(f"{k}_of")
    how = F.coalesce(*[F.when(F.col(f"by_{k}").isNotNull(), k) for k in keys])
    return out.select(*items.columns, F.coalesce(*[F.col(f"by_{k}") for k in keys]).alias("found"), how.alias("how"))


def without_category(items: DataFrame, manifest: DataFrame, key: str, default: str, excluded: list[str]) -> DataFrame:
    """items with the category that the manifest (key, category) gives them, or the default; excluded categories left out."""
    one = manifest.groupBy(key).agg(F.min("category").alias("category"))
    return items.join(one, key, "left").withColumn("category", F.coalesce("category", F.lit(default))).where(~F.col("category").isin(*excluded))


def pair_mismatch(rows: DataFrame, key: str, kind: str, first: str, second: str, most: int) -> DataFrame:
    """Keys whose counts of two kinds differ by more than most."""
    g = rows.groupBy(key).agg(F.count_if(F.col(kind) == first).alias("first"), F.count_if(F.col(kind) == second).alias("second"))
    return g.where(F.abs(F.col("first") - F.col("second")) > most)


def group_compare(groups: DataFrame, others: DataFrame, key: str, n: str, other: str, share: float, tolerance: float, least: int) -> DataFrame:
    """groups (key, n) beside others (key, other), 0 where a group has none; off: further from share * n than the tolerance of it, and than least."""
    both = groups.select(key, n).join(others.select(key, other), key, "left").withColumn(other, F.coalesce(other, F.lit(0)))
    want = F.col(n) * share
    return both.withColumn("off", F.abs(F.col(other) - want) > F.greatest(want * tolerance, F.lit(least)))


def tier_scores(rows: DataFrame, tier: Column, score: Column, places: int = 9) -> DataFrame:
    return rows.groupBy(tier.alias("tier")).agg(F.round(F.avg(score), places).alias("score"), F.count("*").alias("n"))


def field_accuracy(rows: DataFrame, by: str, good: Column) -> DataFrame:
    """By group: right and wrong rows and the rate of right ones; null verdicts don't count."""
    return rows.groupBy(by).agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"), F.round(F.avg(good.cast("int")), 9).alias("rate"))


def at_limit(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """Groups that reach a limit and so may have been cut."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") >= limit).withColumn("cut", F.lit(True))


def confidence_band(confidence: Column) -> Column:
    return F.when(confidence >= 90, "high").when(confidence >= 70, "medium").when(confidence >= 50, "low").otherwise("review")


def missing_cells(rows: DataFrame, key: str, kind: str, expected: list) -> DataFrame:
    """(key, kind) of the expected kinds that a key lacks; the grid is exploded from a constant list."""
    have = rows.select(key, kind).distinct()
    grid = have.select(key).distinct().select(key, F.explode(F.array(*map(F.lit, expected))).alias(kind))
    return grid.join(have, [key, kind], "left_anti")


def conditional_counts(rows: DataFrame, by: list[str], condition: Column, name: str) -> DataFrame:
    """By group: rows, rows that meet the condition, and their share."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(condition).alias(name), (F.count_if(condition) / F.count("*")).alias("share"))


def duplicates_in_group(items: DataFrame, name: str, id_col: str, inside: DataFrame) -> DataFrame:
    """DED5: names of later copies, with their number, of names that occur in a group (inside: name)."""
    from .dedup import later_copies

    copies = later_copies(items.select(id_col, name), name, id_col, "exact_name").join(items.select(id_col, name), id_col)
    return copies.join(inside.select(name).distinct(), name, "left_semi").groupBy(name).agg(F.count("*").alias("copies"))


def with_source_rows(errors: DataFrame, rows: DataFrame, key: str, *measures: Column) -> DataFrame:
    """JN28: errors with what the source rows of their key add up to; an error without rows stays. Rows are reduced to their key before the join."""
    return errors.join(rows.groupBy(key).agg(*measures), key, "left")


def source_of_record(records: DataFrame, sources: DataFrame, stem: str, record: str, source: str) -> DataFrame:
    """JN27: records with the first source document of their stem, where one exists."""
    first = sources.where(F.col(stem) != "").groupBy(stem).agg(F.min(source).alias("source_id"))
    return records.where(F.col(stem) != "").join(first, stem).select(record, "source_id")


def mapped_totals(items: DataFrame, by: str, mapped: Column, total: str = "texts", yes: str = "with_numbers", no: str = "without") -> DataFrame:
    """AG8: items of each group, with and without a mapping."""
    has = F.coalesce(mapped, F.lit(False))
    return items.groupBy(by).agg(F.count("*").alias(total), F.count_if(has).alias(yes), F.count_if(~has).alias(no))


def annotator_volumes(labels: DataFrame, annotators: list[str]) -> DataFrame:
    """AG40: how often each annotator (a column) gave each kind, from one pass of the table."""
    both = labels.select(F.explode(F.array(*[F.struct(F.lit(c).alias("annotator"), F.col(c).cast("string").alias("kind")) for c in annotators])).alias("x")).select("x.*")
    return both.groupBy("annotator", "kind").agg(F.count("*").alias("n"))


def lowest_matches(pairs: DataFrame, similarity: Column, below: float, *keep: str, places: int = 6) -> DataFrame:
    """SL6: pairs whose similarity is below a bound. The rows aren't sorted: a report sorts what it shows."""
    return pairs.select(*keep, F.round(similarity, places).alias("similarity")).where(F.col("similarity") < below)


def flat_records(records: DataFrame, key: str, parts: Column, group: Column, parts_name: str = "slides", group_name: str = "term") -> DataFrame:
    """FN45: records as a flat list of key, number of parts and group."""
    return records.select(key, F.size(parts).cast("long").alias(parts_name), group.alias(group_name))


def run_summary(changes: DataFrame, kind: str, keys: str, most: int = 5) -> DataFrame:
    """AG39: what a run would do, by kind of change: number, the different keys it touches, and the first names; the plan that a dry run shows."""
    from .rollup import examples

    n = changes.groupBy(kind).agg(F.count_distinct(keys).alias("keys"))
    shown = examples(changes, [kind], "name", most)
    return shown.join(n, kind).select(kind, "n", "keys", "examples")


def loss_examples(lost: DataFrame, stage: str, text: str, most: int = 5, width: int = 80) -> DataFrame:
    """AG12: losses of each stage with the first texts, each cut to a width."""
    from .rollup import examples

    return examples(lost.withColumn(text, F.substring(text, 1, width)), [stage], text, most)

