"""Streams: event ingest, de-duplication within a watermark, flattening, running counts, incremental diffs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

ACTIVITY = "ts timestamp, actors array<struct<person_name:string,is_current_user:boolean>>, actions array<struct<type:string,detail:variant>>, targets array<struct<title:string,name:string,mime_type:string,file_id:string>>"


#: What is typed of an activity response; an action's detail stays text here, since its one key is its type.
RESPONSE = (
    "activities array<struct<timestamp:string,timeRange:struct<startTime:string,endTime:string>,actors:array<struct<user:struct<knownUser:struct<personName:string,isCurrentUser:boolean>>>>,"
    "actions:array<struct<detail:string>>,targets:array<struct<driveItem:struct<title:string,name:string,mimeType:string>>>>>"
)


def read_events(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100, kind: str = "parquet") -> DataFrame:
    """New files of a folder as they come; the checkpoint of the query that reads it remembers what was seen."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(kind).load(path)


def deduplicated(events: DataFrame, keys: list[str], ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """One event for each key within the delay; state older than the watermark is dropped, later rows count as late."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def flattened(activity: DataFrame) -> DataFrame:
    """A row for each actor, action and target of an activity; an activity without targets keeps a null target."""
    a = activity.select("ts", F.explode_outer("actors").alias("actor"), "actions", "targets").select("ts", "actor", F.explode_outer("actions").alias("action"), "targets").select("ts", "actor", "action", F.explode_outer("targets").alias("target"))
    return a.select("ts", F.col("actor.person_name").alias("user"), F.col("action.type").alias("action"), F.col("action.detail").alias("detail"), F.col("target.file_id").alias("file_id"), F.coalesce("target.title", "target.name").alias("title"))


def parsed_activities(responses: DataFrame, text: str = "response") -> DataFrame:
    """A row for each activity of JSON responses, with the responses' other columns: timestamp (its own, else the end of its range, else the start, else empty), actors, actions (type:
    the first key of the detail, unknown without one; detail: what that key holds, as VARIANT) and targets. Missing texts are empty, a missing flag is false; a response that doesn't parse has no rows.
    """
    others = [c for c in responses.columns if c != text]
    a = responses.select(*others, F.explode(F.from_json(text, RESPONSE)["activities"]).alias("a"))
    empty = lambda c: F.coalesce(c, F.lit(""))
    filled = lambda c: F.nullif(c, F.lit(""))
    none = lambda c, kind: F.coalesce(c, F.array().cast(kind))
    actors = F.transform(none(F.col("a.actors"), "array<struct<user:struct<knownUser:struct<personName:string,isCurrentUser:boolean>>>>"), lambda x: F.struct(empty(x["user"]["knownUser"]["personName"]).alias("person_name"), F.coalesce(x["user"]["knownUser"]["isCurrentUser"], F.lit(False)).alias("is_current_user")))

    def action(x):
        kind = F.get(F.json_object_keys(x["detail"]), 0)
        held = F.try_variant_get(F.try_parse_json(x["detail"]), F.concat(F.lit("$['"), kind, F.lit("']")), "variant")
        return F.struct(F.coalesce(kind, F.lit("unknown")).alias("type"), F.coalesce(held, F.parse_json(F.lit("{}"))).alias("detail"))

    def target(x):
        item = x["driveItem"]
        return F.struct(empty(item["title"]).alias("title"), empty(item["name"]).alias("name"), empty(item["mimeType"]).alias("mime_type"), F.replace(empty(item["name"]), F.lit("items/"), F.lit("")).alias("file_id"))

    targets = F.transform(none(F.col("a.targets"), "array<struct<driveItem:struct<title:string,name:string,mimeType:string>>>"), target)
    stamp = F.coalesce(filled(F.col("a.timestamp")), filled(F.col("a.timeRange.endTime")), empty(F.col("a.timeRange.startTime")))
    return a.select(*others, stamp.alias("timestamp"), actors.alias("actors"), F.transform(none(F.col("a.actions"), "array<struct<detail:string>>"), action).alias("actions"), targets.alias("targets"))


def detail_schemas(activities: DataFrame) -> DataFrame:
    """Per action type how often it occurs and the schema that the details of all its actions have together."""
    each = activities.select(F.explode("actions").alias("x"))
    return each.groupBy(F.col("x.type").alias("type")).agg(F.count("*").alias("n"), F.schema_of_variant_agg("x.detail").alias("schema"))


def running_counts(events: DataFrame, *keys: str) -> DataFrame:
    return events.groupBy(*keys).agg(F.count("*").alias("n"))


def windowed_counts(events: DataFrame, *keys: str, ts: str = "ts", delay: str = "1 hour", width: str = "1 hour") -> DataFrame:
    """Counts in event-time windows, given out once the watermark has passed them."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def key_changes(files: DataFrame, key: str = "id", content: str = "md5", name: str = "name", modified: str = "modified_time") -> DataFrame:
    """The change rows of a stream of file rows against what was last seen of each key: NEW, MODIFIED, METADATA_CHANGED or RENAMED, as in snapshot_diff.

    The stream's state store keeps content, name and time of each key, so a batch touches the keys it has and nothing else; old versions go by the store's own rules. A
    key that comes more than once in a batch counts with the row last modified, whatever the number of its rows.
    """
    fields = [content, name, modified]
    of = lambda *names: StructType([StructField(n, files.schema[c].dataType) for n, c in names])
    out = StructType([files.schema[key], StructField("change_type", StringType()), *of((name, name), (f"previous_{name}", name), (f"previous_{content}", content))])
    keep = of(*[(c, c) for c in fields])

    def told(value):
        return None if value is None or str(value) == "" else value

    def step(group, batches, state):
        now = None
        for rows in batches:
            for row in rows[fields].astype(object).where(rows[fields].notna(), None).itertuples(index=False, name=None):
                rank = tuple((v is not None, v) for v in (row[2], row[0], row[1]))
                now = (rank, row) if now is None or rank > now[0] else now
        row, was = now[1], state.get if state.exists else None
        differs = lambda i: was is not None and told(row[i]) is not None and told(was[i]) is not None and row[i] != was[i]
        change = "NEW" if was is None else "MODIFIED" if differs(0) else "METADATA_CHANGED" if differs(2) else "RENAMED" if differs(1) else None
        state.update(row)
        if change:
            yield pd.DataFrame([[group[0], change, row[1], was[1] if was else None, was[0] if was else None]], columns=out.names)

    return files.groupBy(key).applyInPandasWithState(step, out, keep, "append", "NoTimeout")


def start_diffs(files: DataFrame, changes: str, checkpoint: str, **columns: str):
    """Writes the change rows of each batch (see key_changes) to a folder of its number, so a batch that is run again after a failure replaces its own rows only."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{changes}/batch={number}")

    return key_changes(files, **columns).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_new_files(files: DataFrame, manifest: str, out: str, checkpoint: str, key: str = "path"):
    """Files that the manifest table lacks are written as pending_review."""

    def step(batch: DataFrame, number: int) -> None:
        known = batch.sparkSession.read.parquet(manifest).select(key)
        batch.dropDuplicates([key]).join(known, key, "left_anti").withColumn("category", F.lit("pending_review")).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return files.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
