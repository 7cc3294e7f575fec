"""The standing checks of records (term, lesson, title, arrays of topics, objectives, tools, videos, resources, keywords, images ...), as rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .expect import Rule, expect, unique
from .reconcile import contained

RECORD = "term int, lesson int, title string, topics array<string>, objectives array<string>, tools array<string>, keywords array<string>, signals array<string>, activity string, videos array<struct<title:string,url:string>>, resources array<string>, images array<struct<image_path:string>>, grade_band string, pipeline_version string, generated_at string"
ARRAYS = ("topics", "objectives", "tools", "keywords", "signals", "videos", "resources", "images")


def any_of(array: str, test) -> Column:
    return F.exists(F.coalesce(F.col(array), F.array().cast("array<string>")) if array not in ("videos", "images") else F.col(array), test)


def blank(x: Column) -> Column:
    return F.coalesce(F.trim(x), F.lit("")) == ""


def record_rules(tools: list[str], lessons: int, hosts: list[str] | str) -> list[Rule]:
    """hosts: names of video hosts, or a pattern of LIKE."""
    valid = lambda u: u.rlike(r"^https?://[^\s/]+\.[^\s]+$")
    known = lambda u: T.host(u).like(hosts) if isinstance(hosts, str) else T.host(u).isin(hosts)
    missing = F.lit(False)
    for a in ARRAYS:
        missing = missing | F.col(a).isNull()
    c = F.col
    return [
        Rule("S002", "ERROR", blank(c("title")), "title isn't empty"),
        Rule("S005", "ERROR", ~F.coalesce(c("lesson").between(1, lessons), F.lit(False)), "lesson in range"),
        Rule("S006", "WARNING", any_of("topics", blank), "topics aren't blank"),
        Rule("S007", "WARNING", any_of("objectives", blank), "objectives aren't blank"),
        Rule("S008", "WARNING", F.size(F.array_except(F.coalesce("tools", F.array().cast("array<string>")), F.array(*map(F.lit, tools)))) > 0, "tools are canonical"),
        Rule("S009", "WARNING", F.coalesce(F.exists("videos", lambda v: blank(v["url"])), F.lit(False)), "videos have urls"),
        Rule("S011", "WARNING", any_of("keywords", blank), "keywords aren't blank"),
        Rule("S012", "INFO", F.coalesce(F.exists("images", lambda v: blank(v["image_path"])), F.lit(False)), "images have paths"),
        Rule("S013", "WARNING", ~F.coalesce(c("grade_band").rlike(r"^G?\d{1,2}\s*[-–]\s*G?\d{1,2}$"), F.lit(False)), "grade band pattern"),
        Rule("S014", "INFO", blank(c("pipeline_version")), "version is given"),
        Rule("S015", "ERROR", missing, "arrays are never null"),
        Rule("C001", "ERROR", F.coalesce(c("title").rlike(r"(?i)^slide\s+\d+$"), F.lit(False)), "title isn't a slide number"),
        Rule("C002", "WARNING", any_of("objectives", lambda x: F.length(x) < 10), "objectives have ten characters"),
        Rule("C003", "WARNING", F.coalesce(F.size("topics") != F.size(F.array_distinct("topics")), F.lit(False)), "topics occur once"),
        Rule("C004", "WARNING", F.coalesce(F.length("activity").between(1, 49), F.lit(False)), "activities have fifty characters"),
        Rule("C005", "WARNING", any_of("resources", lambda x: (F.size(T.urls(x)) > 0) & F.exists(T.urls(x), lambda u: ~valid(u))), "resource urls are valid"),
        Rule("C006", "WARNING", F.coalesce(F.exists("videos", lambda v: ~(known(v["url"]) | F.lower(v["url"]).rlike(r"\.(mp4|mov|avi|webm)$"))), F.lit(False)), "video hosts are known"),
        Rule("C007", "INFO", any_of("keywords", lambda x: F.length(x) < 2), "keywords have two characters"),
        Rule("C011", "INFO", any_of("resources", lambda x: F.size(T.urls(x)) == 0), "resources have urls"),
        Rule("C012", "WARNING", F.coalesce(F.arrays_overlap(F.transform("videos", lambda v: v["url"]), F.flatten(F.transform("resources", T.urls))), F.lit(False)), "no url is video and resource"),
        Rule("C013", "WARNING", any_of("signals", lambda x: F.length(F.trim(x)) < 3), "signals say something"),
        Rule("C014", "INFO", F.coalesce((F.length("activity") > 100) & c("activity").rlike(r"[\p{L}\p{N}]$"), F.lit(False)), "texts aren't cut inside a word"),
        Rule("I003", "WARNING", F.coalesce(F.exists("videos", lambda v: F.contains(v["url"], F.lit(" "))), F.lit(False)), "urls have no spaces"),
        Rule("I006", "WARNING", F.try_to_timestamp("generated_at").isNull(), "timestamps are valid", 3),
        Rule("I007", "WARNING", F.coalesce(F.size("images") != F.size(F.array_distinct("images")), F.lit(False)), "image paths occur once", 3),
    ]


def check_records(records: DataFrame, tools: list[str], lessons: int, hosts: list[str] | str, coverage: dict[str, float] | None = None) -> DataFrame:
    """All rules in one scan, key and title uniqueness, and the share of records that fill a field, against its threshold."""
    filled = lambda f: ~blank(F.col(f)) if dict(records.dtypes)[f] == "string" else F.coalesce(F.size(f) > 0, F.lit(False))
    rules = record_rules(tools, lessons, hosts) + [Rule(f"UC_{f}", "WARNING", ~filled(f), f"{f} filled", 4, 1 - share) for f, share in (coverage or {}).items()]
    return expect(records, rules).union(unique(records, ["term", "lesson"], "I005", "ERROR", 3)).union(unique(records, ["term", "title"], "X006", "ERROR"))


def title_number_mismatch(records: DataFrame) -> DataFrame:
    """Records whose title names another lesson than their own."""
    n = F.nullif(F.regexp_extract("title", r"(?i)lesson\s*(\d+)", 1), F.lit("")).cast("int")
    return records.where(n.isNotNull() & (n != F.col("lesson"))).select("term", "lesson", "title")


def missing_lessons(records: DataFrame, profile: DataFrame) -> DataFrame:
    """Expected (term, lesson) that have no record; profile: (term, lessons)."""
    return profile.select("term", F.explode(F.sequence(F.lit(1), F.col("lessons"))).alias("lesson")).join(records.select("term", "lesson"), ["term", "lesson"], "left_anti")


def lookups(records: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Stored lookups (id, term, lesson, value): by key, or records of which any field holds the value; matches counts records."""
    s = scenarios.select("id", F.col("term").alias("s_term"), F.col("lesson").alias("s_lesson"), F.col("value").alias("s_value"))
    keyed = s.where("s_value is null").join(records, (F.col("term") == F.col("s_term")) & (F.col("lesson") == F.col("s_lesson"))).groupBy("id").agg(F.count("*").alias("matches"))
    whole = records.groupBy(F.lower(F.to_json(F.struct(*records.columns))).alias("norm")).agg(F.count("*").alias("copies")).withColumn("hay_id", F.sha2("norm", 256))
    hits = contained(s.where("s_value is not null").select(F.col("id").alias("needle_id"), F.lower("s_value").alias("norm")), whole)
    valued = hits.join(whole.select("hay_id", "copies"), "hay_id").groupBy(F.col("needle_id").alias("id")).agg(F.sum("copies").alias("matches"))
    n = F.coalesce("matches", F.lit(0))
    return s.select("id").join(keyed.union(valued), "id", "left").select("id", n.alias("matches"), (n > 0).alias("passed"))
