from pyspark.sql import functions as F

from corpusloom.streaming import feeds


def run(stream, spark, name, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_events(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = feeds.read_events(spark, str(tmp_path / "in"), events.schema.simpleString().removeprefix("struct<")[:-1].replace(":", " "), 1)
    counts = run(feeds.running_counts(stream, "user_id", "event_type"), spark, "counts", "complete")
    assert counts.exceptAll(events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))).isEmpty()
    same = feeds.read_events(spark, str(tmp_path / "in"), events.schema.simpleString().removeprefix("struct<")[:-1].replace(":", " "))
    one = run(feeds.deduplicated(same.select("event_type", "ts"), ["event_type"], delay="100 days"), spark, "dedup")
    assert one.count() == events.select("event_type").distinct().count()
    windows = run(feeds.windowed_counts(same, "event_type"), spark, "windows")
    assert 0 < windows.agg(F.sum("n")).first()[0] <= events.count()


def test_activity(spark, tmp_path):
    import json

    two = {"timestamp": "2024-01-01T00:00:00Z", "actors": [{"user": {"knownUser": {"personName": "ann", "isCurrentUser": True}}}, {}], "actions": [{"detail": {"move": {"to": [1, {"b": None}]}, "edit": {}}}, {"detail": {}}, {}], "targets": [{"driveItem": {"name": "items/x1", "title": "T", "mimeType": "m"}}]}
    rows = [(1, json.dumps({"activities": [two, {"timeRange": {"startTime": "s", "endTime": "e"}}, {"timestamp": "", "timeRange": {"startTime": "s"}}, {}]})), (2, "not json"), (3, None), (4, "{}")]
    a = feeds.parsed_activities(spark.createDataFrame(rows, "id int, response string"))
    got = a.selectExpr("id", "timestamp", "actors", "transform(actions, x -> struct(x.type, to_json(x.detail) AS detail)) AS actions", "targets").collect()
    assert [(r.id, r.timestamp, len(r.actors), len(r.actions), len(r.targets)) for r in got] == [(1, "2024-01-01T00:00:00Z", 2, 3, 1), (1, "e", 0, 0, 0), (1, "s", 0, 0, 0), (1, "", 0, 0, 0)]
    assert [tuple(x) for x in got[0].actors] == [("ann", True), ("", False)] and tuple(got[0].targets[0]) == ("T", "items/x1", "m", "x1")
    assert [(x.type, json.loads(x.detail)) for x in got[0].actions] == [("move", {"to": [1, {"b": None}]}), ("unknown", {}), ("unknown", {})]
    assert {(r.type, r.n, r.schema) for r in feeds.detail_schemas(a).collect()} == {("move", 1, "OBJECT<to: ARRAY<VARIANT>>"), ("unknown", 2, "OBJECT<>")}
    typed = a.withColumn("ts", F.try_to_timestamp("timestamp")).drop("id", "timestamp").where("ts is not null")
    assert [(r.user, r.action, r.file_id) for r in feeds.flattened(typed).where("user = 'ann'").orderBy("action").collect()] == [("ann", "move", "x1"), ("ann", "unknown", "x1"), ("ann", "unknown", "x1")]
    typed.write.parquet(str(tmp_path / "a"))
    stream = feeds.flattened(feeds.read_events(spark, str(tmp_path / "a"), feeds.ACTIVITY)).withColumn("detail", F.to_json("detail"))
    assert run(stream, spark, "flat").count() == 6


def test_incremental_diff(spark, tmp_path):
    schema = "id string, md5 string, name string, modified_time string"
    src = str(tmp_path / "in")
    start = lambda: feeds.start_diffs(feeds.read_events(spark, src, schema, 1), str(tmp_path / "changes"), str(tmp_path / "cp"))
    spark.createDataFrame([("1", "a", "x", "t"), ("2", "b", "y", "t")], schema).coalesce(1).write.mode("append").parquet(src)
    start().awaitTermination(120)
    spark.createDataFrame([("1", "a2", "x", "t"), ("2", "b", "y", "t"), ("3", "c", "z", "t")], schema).coalesce(1).write.mode("append").parquet(src)
    start().awaitTermination(120)
    got = {(r.batch, r.id, r.change_type) for r in spark.read.parquet(str(tmp_path / "changes")).collect()}
    assert got == {(0, "1", "NEW"), (0, "2", "NEW"), (1, "1", "MODIFIED"), (1, "3", "NEW")}
    more = [("1", "a2", "x9", "t"), ("2", "", "y", "t2"), ("2", "b", "y", "t1"), ("3", "c", "z", "t"), (None, "n", "n", "t")]
    spark.createDataFrame(more, schema).coalesce(1).write.mode("append").parquet(src)
    start().awaitTermination(120)
    rows = {(r.id, r.change_type, r.name, r.previous_name, r.previous_md5) for r in spark.read.parquet(str(tmp_path / "changes")).where("batch = 2").collect()}
    assert rows == {("1", "RENAMED", "x9", "x", "a2"), ("2", "METADATA_CHANGED", "y", "y", "b"), (None, "NEW", "n", None, None)}
    kept = {r.key.id: (r.value[0], r.value[2]) if len(r.value) == 3 else r.value for r in spark.read.format("statestore").load(str(tmp_path / "cp")).collect()}
    assert set(kept) == {"1", "2", "3", None}  # the state holds each key once, whatever the batches
    spark.createDataFrame([("a",)], "path string").write.parquet(str(tmp_path / "manifest"))
    spark.createDataFrame([("a",), ("b",), ("b",)], "path string").write.parquet(str(tmp_path / "files"))
    feeds.start_new_files(feeds.read_events(spark, str(tmp_path / "files"), "path string"), str(tmp_path / "manifest"), str(tmp_path / "pending"), str(tmp_path / "cp2")).awaitTermination(120)
    assert [(r.path, r.category) for r in spark.read.parquet(str(tmp_path / "pending")).collect()] == [("b", "pending_review")]
