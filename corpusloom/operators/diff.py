"""Comparing two snapshots, and what a set of changes makes stale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snapshot_diff(current: DataFrame, previous: DataFrame, key: str, content: str, name: str, modified: str) -> DataFrame:
    """Full outer join on key: NEW, DELETED, MODIFIED (content), METADATA_CHANGED (time), RENAMED (name) or UNCHANGED, in this order.

    An empty or missing content hash on either side says nothing about the content.
    """
    cols = [key, content, name, modified]
    cur, prev = current.select(*[F.col(c).alias(f"cur_{c}") for c in cols]), previous.select(*[F.col(c).alias(f"prev_{c}") for c in cols])
    both = cur.join(prev, F.col(f"cur_{key}") == F.col(f"prev_{key}"), "full_outer")
    told = lambda c: F.nullif(F.col(c).cast("string"), F.lit(""))
    differs = lambda c: told(f"cur_{c}") != told(f"prev_{c}")
    change = F.when(F.col(f"prev_{key}").isNull(), "NEW").when(F.col(f"cur_{key}").isNull(), "DELETED").when(differs(content), "MODIFIED").when(differs(modified), "METADATA_CHANGED").when(differs(name), "RENAMED").otherwise("UNCHANGED")
    return both.select(F.coalesce(f"cur_{key}", f"prev_{key}").alias(key), change.alias("change_type"), F.col(f"cur_{name}").alias(name), F.col(f"prev_{name}").alias(f"previous_{name}"), F.col(f"prev_{content}").alias(f"previous_{content}"))


def asset_diff(current: DataFrame, previous: DataFrame, group: str, key: str, content: str) -> DataFrame:
    """Per group with any change: sorted keys ADDED, CHANGED and REMOVED, and how many are unchanged."""
    cur, prev = current.select(group, key, F.col(content).alias("now")), previous.select(group, key, F.col(content).alias("was"))
    state = F.when(F.col("was").isNull(), "ADDED").when(F.col("now").isNull(), "REMOVED").when(F.col("now") != F.col("was"), "CHANGED").otherwise("UNCHANGED")
    each = cur.join(prev, [group, key], "full_outer").withColumn("state", state)
    listed = lambda s: F.array_sort(F.collect_list(F.when(F.col("state") == s, F.col(key)))).alias(s.lower())
    return each.groupBy(group).agg(*map(listed, ("ADDED", "CHANGED", "REMOVED")), F.count_if(F.col("state") == "UNCHANGED").alias("unchanged")).where("size(added) + size(changed) + size(removed) > 0")


def missing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of left whose key right doesn't have: new files against a manifest, or stale entries the other way round."""
    return left.join(right.select(key), key, "left_anti")


def stages_to_run(changes: DataFrame, plan: DataFrame) -> DataFrame:
    """One row: sorted stages that the changes' categories ask for. plan: (category, stages), small by its nature."""
    return changes.select("category").distinct().join(plan, "category").select(F.explode("stages").alias("stage")).agg(F.array_sort(F.collect_set("stage")).alias("stages"))


def within(actual: Column, expected: Column, share: float) -> Column:
    """Whether actual is within a share of expected; zero expects zero."""
    return F.when(expected == 0, actual == 0).otherwise(actual.between(expected * (1 - share), expected * (1 + share)))
