"""Sinks: partitioned JSON, run logs, snapshot partitions, CSV exports, upserts, archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_by_key(df: DataFrame, key: str, path: str, combined: str | None = None) -> None:
    """JSON with a folder for each key; combined: also everything in one place."""
    df.write.mode("overwrite").partitionBy(key).json(path)
    if combined:
        df.write.mode("overwrite").json(combined)


def append_run(df: DataFrame, path: str, run_ts: str) -> None:
    df.withColumn("run_ts", F.lit(run_ts).cast("timestamp")).write.mode("append").parquet(path)


def latest_run(spark: SparkSession, path: str) -> DataFrame:
    log = spark.read.parquet(path)
    return log.join(F.broadcast(log.agg(F.max("run_ts").alias("run_ts"))), "run_ts", "left_semi")  # one row


def write_snapshot(df: DataFrame, path: str, snapshot_id: str, dry_run: bool = False) -> None:
    """Replace one snapshot's partition, and only that."""
    if not dry_run:
        df.withColumn("snapshot_id", F.lit(snapshot_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_id").parquet(path)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows unless new has their key."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def export_csv(df: DataFrame, path: str, tags: str | None = None, cut: dict[str, int] | None = None) -> None:
    """CSV with tags joined by |, long texts cut, other nested columns as JSON."""
    out = df
    for c, kind in df.dtypes:
        if c == tags:
            out = out.withColumn(c, F.array_join(c, "|"))
        elif kind.startswith(("array", "struct", "map")):
            out = out.withColumn(c, F.to_json(c))
        elif cut and c in cut:
            out = out.withColumn(c, F.substring(c, 1, cut[c]))
    out.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def archive_if_passed(df: DataFrame, verdicts: DataFrame, path: str, build: str) -> bool:
    """Write the build to the archive only if its verdict row says PASS."""
    if verdicts.where("verdict = 'PASS'").isEmpty():
        return False
    df.withColumn("build", F.lit(build)).write.mode("append").partitionBy("build").parquet(path)
    return True


def append_alerts(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
