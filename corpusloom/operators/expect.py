"""Declarative expectations: rules are rows, rules of one grain are aggregates of one scan, results are check rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """bad marks rows that break the rule; the check passes while at most `allowed` of the rows do."""

    check_id: str
    severity: str
    bad: Column
    message: str
    layer: int = 1
    allowed: float = 0.0


def expect(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row for each rule: check_id, layer, passed, severity, failures, total, message. The table is read once for all rules."""
    sums = df.agg(F.count("*").alias("total"), *[F.count_if(F.coalesce(r.bad, F.lit(True))).alias(f"r{i}") for i, r in enumerate(rules)])
    made = [F.struct(F.lit(r.check_id).alias("check_id"), F.lit(r.layer).alias("layer"), F.lit(r.severity).alias("severity"), F.lit(r.message).alias("message"), F.lit(r.allowed).alias("allowed"), F.col(f"r{i}").alias("failures"), F.col("total")) for i, r in enumerate(rules)]
    out = sums.select(F.explode(F.array(*made)).alias("x")).select("x.*")
    return out.select("check_id", "layer", (F.col("failures") <= F.col("allowed") * F.col("total")).alias("passed"), "severity", "failures", "total", "message")


def unique(df: DataFrame, keys: list[str], check_id: str, severity: str, layer: int = 1) -> DataFrame:
    """Check that no two rows share the keys."""
    n = df.groupBy(*keys).count().agg(F.count_if(F.col("count") > 1).alias("failures"), F.count("*").alias("total"))
    return n.select(F.lit(check_id).alias("check_id"), F.lit(layer).alias("layer"), (F.col("failures") == 0).alias("passed"), F.lit(severity).alias("severity"), "failures", "total", F.lit("keys occur once").alias("message"))


def referenced(df: DataFrame, key: str, parent: DataFrame, parent_key: str, check_id: str, severity: str, layer: int = 1) -> DataFrame:
    """Check that every non-null key has a parent."""
    orphans = df.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti").agg(F.count("*").alias("failures"))
    return orphans.select(F.lit(check_id).alias("check_id"), F.lit(layer).alias("layer"), (F.col("failures") == 0).alias("passed"), F.lit(severity).alias("severity"), "failures", F.col("failures").alias("total"), F.lit("parents exist").alias("message"))


def regression(current: DataFrame, previous: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Per field: rows that had it before and lost it; and one row on the number of keys."""
    both = previous.select(key, *[F.col(f).alias(f"p_{f}") for f in fields]).join(current.select(key, F.lit(1).alias("here"), *fields), key, "full_outer")
    lost = [F.struct(F.lit(f"lost_{f}").alias("check_id"), F.count_if(F.col(f"p_{f}").isNotNull() & F.col(f).isNull() & F.col("here").isNotNull()).alias("failures")) for f in fields]
    gone = F.struct(F.lit("lost_rows").alias("check_id"), F.count_if(F.col("here").isNull()).alias("failures"))
    return both.agg(F.array(gone, *lost).alias("x")).select(F.explode("x").alias("x")).select("x.check_id", "x.failures", (F.col("x.failures") == 0).alias("passed"))


def completeness(df: DataFrame, fields: list[str]) -> Column:
    """Share of filled fields of a row."""
    return sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0)) / len(fields)


def quality_cube(checks: DataFrame) -> DataFrame:
    """Total, passed and failed by layer and severity and over all levels of both (null: all)."""
    return checks.cube("layer", "severity").agg(F.count("*").alias("total"), F.count_if("passed").alias("ok"), F.count_if(~F.col("passed")).alias("failed"))


def verdict(checks: DataFrame, user_layer: int = 4) -> DataFrame:
    """PASS without failed errors and with all of the user layer passed, FAIL with a failed error, else NEEDS_REVIEW; the layer's rate is 0 if it didn't run."""
    user = F.col("layer") == user_layer
    sums = checks.agg(F.count_if(~F.col("passed") & (F.col("severity") == "ERROR")).alias("errors"), F.count_if(~F.col("passed") & (F.col("severity") == "WARNING")).alias("warnings"), F.count_if(user & F.col("passed")).alias("ok"), F.count_if(user).alias("n"))
    rate = F.when(F.col("n") == 0, 0.0).otherwise(F.col("ok") / F.col("n"))
    return sums.select("errors", "warnings", rate.alias("user_rate"), F.when(F.col("errors") > 0, "FAIL").when(rate >= 1.0, "PASS").otherwise("NEEDS_REVIEW").alias("verdict"))
