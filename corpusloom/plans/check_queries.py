"""Queries of the checks, scores and reconciliation over records that are read from the pages, and over documents; each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks, record_checks, reconcile, rollup, scores
from ..operators.expect import expect
from ..session import saved
from .queries import NORM, query, read

#: Records as SQL: one for each page, its fields read from the page's markup; times and versions are gone from some of them by rule.
REC = r"""
rec AS (SELECT page_id, CASE regexp_extract(html, 'lang="([a-z]+)"', 1) WHEN 'en' THEN 1 WHEN 'de' THEN 2 WHEN 'fr' THEN 3 ELSE 4 END AS term, CAST(page_id % 60 + 1 AS INTEGER) AS lesson,
  trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1) AS topics, regexp_extract_all(html, '<p>([^<]{0,40})', 1) AS objectives,
  string_split(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), ' ') AS keywords, regexp_extract(html, '<footer>([^<]*)', 1) AS activity, regexp_extract_all(html, 'href="([^"]*)"', 1) || [url] AS resources,
  url AS video_url, regexp_extract_all(html, 'class="ad">([^<]{0,12})', 1) AS images, CASE WHEN page_id % 7 = 0 THEN 'G5' ELSE 'G5-G8' END AS grade_band, CASE WHEN page_id % 9 = 0 THEN '' ELSE '1.0' END AS pipeline_version,
  CASE WHEN page_id % 10 = 0 THEN 'soon' WHEN page_id % 10 = 1 THEN '' ELSE '2024-03-0' || (page_id % 9 + 1) || ' 10:00:00' END AS generated_at FROM pages)
"""


def page_records(spark, sf_dir):
    """The same records as a table of the record checks' schema."""
    p, html = read(spark, sf_dir, "pages"), F.col("html")
    every = lambda pattern: F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    lang, i = F.regexp_extract(html, 'lang="([a-z]+)"', 1), F.col("page_id")
    title = F.trim(F.regexp_extract(html, "<title>([^<]*)</title>", 1))
    words = F.split(title, " ")
    made = F.when(i % 10 == 0, "soon").when(i % 10 == 1, "").otherwise(F.concat(F.lit("2024-03-0"), (i % 9 + 1).cast("string"), F.lit(" 10:00:00")))
    objectives = every("<p>([^<]{0,40})")
    return p.select(
        "page_id",
        F.when(lang == "en", 1).when(lang == "de", 2).when(lang == "fr", 3).otherwise(4).alias("term"),
        (i % 60 + 1).cast("int").alias("lesson"),
        title.alias("title"),
        every('<li><a href="[^"]*">([^<]*)</a>').alias("topics"),
        objectives.alias("objectives"),
        F.slice(words, 1, 2).alias("tools"),
        words.alias("keywords"),
        F.slice(objectives, 1, 3).alias("signals"),
        F.regexp_extract(html, "<footer>([^<]*)", 1).alias("activity"),
        F.array(F.struct(title.alias("title"), F.col("url").alias("url"))).alias("videos"),
        F.concat(every('href="([^"]*)"'), F.array("url")).alias("resources"),
        F.transform(every('class="ad">([^<]{0,12})'), lambda x: F.struct(x.alias("image_path"))).alias("images"),
        F.when(i % 7 == 0, "G5").otherwise("G5-G8").alias("grade_band"),
        F.when(i % 9 == 0, "").otherwise("1.0").alias("pipeline_version"),
        made.alias("generated_at"),
    )


TOOLS = ["The", "Les", "Die", "De"]
_URL = r"^https?://[^\s/]+\.[^\s]+$"
_RULES = {  # id: layer, severity, when a record breaks the rule
    "S002": (1, "ERROR", "title = ''"),
    "S005": (1, "ERROR", "NOT lesson BETWEEN 1 AND 50"),
    "S006": (1, "WARNING", "len(list_filter(topics, lambda x: trim(x) = '')) > 0"),
    "S007": (1, "WARNING", "len(list_filter(objectives, lambda x: trim(x) = '')) > 0"),
    "S008": (1, "WARNING", "len(list_filter(keywords[1:2], lambda x: x NOT IN ('The', 'Les', 'Die', 'De'))) > 0"),
    "S009": (1, "WARNING", "trim(video_url) = ''"),
    "S011": (1, "WARNING", "len(list_filter(keywords, lambda x: trim(x) = '')) > 0"),
    "S012": (1, "INFO", "len(list_filter(images, lambda x: trim(x) = '')) > 0"),
    "S013": (1, "WARNING", r"NOT regexp_matches(grade_band, '^G?\d{1,2}\s*[-–]\s*G?\d{1,2}$')"),
    "S014": (1, "INFO", "pipeline_version = ''"),
    "S015": (1, "ERROR", "topics IS NULL OR objectives IS NULL OR keywords IS NULL OR resources IS NULL OR images IS NULL"),
    "C001": (1, "ERROR", r"regexp_matches(title, '(?i)^slide\s+\d+$')"),
    "C002": (1, "WARNING", "len(list_filter(objectives, lambda x: length(x) < 10)) > 0"),
    "C003": (1, "WARNING", "len(topics) <> len(list_distinct(topics))"),
    "C004": (1, "WARNING", "length(activity) BETWEEN 1 AND 49"),
    "C005": (1, "WARNING", rf"len(list_filter(resources, lambda x: regexp_matches(x, 'https?://[^\s<>\"'')\]]+') AND NOT regexp_matches(rtrim(regexp_extract(x, 'https?://[^\s<>\"'')\]]+'), '.,;:'), '{_URL}'))) > 0"),
    "C006": (1, "WARNING", r"NOT (regexp_extract(video_url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)', 1) LIKE 'www.%' OR regexp_matches(lower(video_url), '\.(mp4|mov|avi|webm)$'))"),
    "C007": (1, "INFO", "len(list_filter(keywords, lambda x: length(x) < 2)) > 0"),
    "C011": (1, "INFO", r"len(list_filter(resources, lambda x: NOT regexp_matches(x, 'https?://[^\s<>\"'')\]]+'))) > 0"),
    "C012": (1, "WARNING", r"list_has_any([video_url], list_transform(list_filter(resources, lambda x: regexp_matches(x, 'https?://[^\s<>\"'')\]]+')), lambda x: rtrim(regexp_extract(x, 'https?://[^\s<>\"'')\]]+'), '.,;:')))"),
    "C013": (1, "WARNING", "len(list_filter(objectives[1:3], lambda x: length(trim(x)) < 3)) > 0"),
    "C014": (1, "INFO", r"length(activity) > 100 AND regexp_matches(activity, '[\p{L}\p{N}]$')"),
    "I003": (1, "WARNING", "contains(video_url, ' ')"),
    "I006": (3, "WARNING", "TRY_CAST(generated_at AS TIMESTAMP) IS NULL"),
    "I007": (3, "WARNING", "len(images) <> len(list_distinct(images))"),
    "UC_title": (4, "WARNING", "title = ''"),
}


def _rows(rules: dict, allowed: dict | None = None) -> str:
    one = "SELECT '{}' AS check_id, {} AS layer, '{}' AS severity, count(*) FILTER (coalesce({}, true)) AS failures, count(*) AS total, count(*) FILTER (coalesce({}, true)) <= {} * count(*) AS passed FROM rec"
    return " UNION ALL ".join(one.format(k, layer, severity, bad, bad, (allowed or {}).get(k, 0)) for k, (layer, severity, bad) in rules.items())


def plain(df):
    return df.select("check_id", "layer", "severity", "failures", "total", "passed")


@query(
    f"WITH {REC} {_rows(_RULES, {'UC_title': 0.1})} UNION ALL SELECT 'I005', 3, 'ERROR', count(*) FILTER (n > 1), count(*), count(*) FILTER (n > 1) = 0 FROM (SELECT count(*) AS n FROM rec GROUP BY term, lesson)"
    " UNION ALL SELECT 'X006', 1, 'ERROR', count(*) FILTER (n > 1), count(*), count(*) FILTER (n > 1) = 0 FROM (SELECT count(*) AS n FROM rec GROUP BY term, title)"
)
def q_record_checks(spark, sf_dir):
    """All row rules of records in one scan, and the uniqueness of keys and titles."""
    return plain(record_checks.check_records(page_records(spark, sf_dir), TOOLS, 50, "www.%", {"title": 0.9}))


_BOUNDS = {
    "S004": (1, "ERROR", "term <> CASE WHEN page_id % 11 = 0 THEN 9 ELSE term END"),
    "C009": (1, "ERROR", "len(list_filter(keywords[1:2], lambda x: x NOT IN ('The', 'Les', 'Die', 'De'))) > 0"),
    "C010": (1, "ERROR", "title = ''"),
    "B001": (3, "WARNING", "len(images) >= 2 AND title = ''"),
    "B002_videos": (3, "INFO", "false"),
    "B002_tools": (3, "INFO", "len(keywords[1:2]) = 0"),
    "B004": (3, "INFO", r"length(rtrim(activity)) > 200 AND (ends_with(rtrim(activity), '...') OR (length(rtrim(activity)) > 1000 AND regexp_matches(rtrim(activity), '[\p{L}\p{N}]$')))"),
    "B005": (3, "WARNING", "len(images) > 0 AND len(resources) > 0 AND len(objectives) = 0 AND len(topics) = 0"),
    "B006": (3, "INFO", "pipeline_version = ''"),
    "E007": (3, "WARNING", rf"len(list_filter(resources, lambda x: regexp_matches(x, '^https?:') AND NOT regexp_matches(x, '{_URL}'))) > 0"),
    "E009": (3, "WARNING", "trim(generated_at) = ''"),
    "UN02": (4, "ERROR", r"regexp_matches(title, '(?i)^(lesson\s+\d+\.pptx$|slide\s+\d+$|untitled|file\s)')"),
}


@query(f"WITH {REC} {_rows(_BOUNDS, {'B002_videos': 1, 'B002_tools': 1, 'B006': 1})}")
def q_boundary_checks(spark, sf_dir):
    """Row rules of outputs and boundaries."""
    rec = page_records(spark, sf_dir).withColumns({"parent_term": F.when(F.col("page_id") % 11 == 0, 9).otherwise(F.col("term")), "canonical_tools": F.array(*map(F.lit, TOOLS)), "native_count": F.size("images"), "source_count": F.size("resources")})
    return plain(expect(rec, checks.boundary_rules(2)))


_GROUPS = f"""
WITH {REC}, n AS (SELECT term, count(*) AS n, min(lesson) AS lo, max(lesson) AS hi, count(DISTINCT lesson) AS d FROM rec GROUP BY term), prof AS (SELECT 1 AS term, 60 AS lessons UNION ALL SELECT 2, 60 UNION ALL SELECT 3, 60 UNION ALL SELECT 5, 10),
grid AS (SELECT term, unnest(range(1, lessons + 1)) AS lesson FROM prof), pos AS (SELECT lesson, row_number() OVER (PARTITION BY term ORDER BY lesson, page_id) AS r FROM rec),
across AS (SELECT count(DISTINCT term) AS n FROM rec WHERE title <> '' GROUP BY lesson, lower(title)), const AS (SELECT count(DISTINCT nullif(grade_band, '')) AS g, count(DISTINCT nullif(pipeline_version, '')) AS v FROM rec GROUP BY term),
kw AS (SELECT count(*) AS n FROM (SELECT unnest(list_distinct(keywords)) AS v FROM rec) GROUP BY v),
c AS (SELECT 'X001' AS check_id, 1 AS layer, 'ERROR' AS severity, count(*) FILTER (coalesce(n.n, 0) <> lessons) AS failures, count(*) AS total FROM prof LEFT JOIN n USING (term)
UNION ALL SELECT 'X002', 1, 'ERROR', count(*) FILTER (r.term IS NULL), count(*) FROM grid LEFT JOIN (SELECT DISTINCT term, lesson FROM rec) r USING (term, lesson)
UNION ALL SELECT 'E002', 3, 'ERROR', count(*) FILTER (n.term IS NULL), count(*) FROM prof LEFT JOIN n USING (term)
UNION ALL SELECT 'X005', 1, 'WARNING', count(*) FILTER (hi - lo + 1 <> d), count(*) FROM n
UNION ALL SELECT 'B007', 3, 'INFO', count(*) FILTER (r <> lesson), count(*) FROM pos
UNION ALL SELECT 'UN03', 4, 'WARNING', count(*) FILTER (TRY_CAST(nullif(regexp_extract(title, '(?i)lesson\\s+(\\d{{1,9}})', 1), '') AS INTEGER) <> lesson), count(*) FROM rec
UNION ALL SELECT 'X007', 1, 'WARNING', CAST(sum(n * (n - 1) // 2) AS BIGINT), CAST(sum(n) AS BIGINT) FROM across
UNION ALL SELECT 'UN05', 4, 'WARNING', count(*) FILTER (g > 1) + count(*) FILTER (v > 1), 2 * count(*) FROM const
UNION ALL SELECT 'C008', 1, 'INFO', count(*) FILTER (n > 0.2 * (SELECT count(*) FROM rec)), count(*) FROM kw
UNION ALL SELECT 'S016', 1, 'ERROR', count(*) FILTER (coalesce(n.n, 0) <> coalesce(lessons, 0)), count(*) FROM prof FULL JOIN n USING (term)
UNION ALL SELECT 'I002', 3, 'INFO', CASE WHEN count(*) FILTER (regexp_matches(title, '[\\x{{0600}}-\\x{{06FF}}]')) = 0 THEN 1 ELSE 0 END, 1 FROM rec
UNION ALL SELECT 'E001', 3, 'ERROR', count(*) FILTER (NOT coalesce(json_valid(props), false)), count(*) FROM events
UNION ALL SELECT 'S001', 1, 'ERROR', 1, 3 UNION ALL SELECT 'S010', 1, 'WARNING', 0, 1
UNION ALL SELECT 'X008', 1, 'INFO', count(*) FILTER (coalesce(TRY_CAST(generated_at AS TIMESTAMP) < TIMESTAMP '2024-03-04 00:00:00', true)), count(*) FROM rec
UNION ALL SELECT 'X009', 1, 'INFO', count(*) FILTER (NOT coalesce(h, false)), count(*) FROM prof LEFT JOIN (SELECT term, bool_or(len(images) > 0) AS h FROM rec GROUP BY term) USING (term) WHERE term <> 2
UNION ALL SELECT 'E003', 3, 'ERROR', count(*) FILTER (coalesce(n.n, 0) <> lessons), count(*) FROM prof LEFT JOIN n USING (term)
UNION ALL SELECT 'E005', 3, 'ERROR', count(*) FILTER (coalesce(n.n, 0) <> lessons), count(*) FROM prof LEFT JOIN n USING (term) WHERE term = 2
UNION ALL SELECT 'I004', 3, 'ERROR', count(*) FILTER (coalesce(n.n, 0) <> lessons), count(*) FROM prof LEFT JOIN n USING (term) WHERE term < 5
UNION ALL SELECT 'B003', 3, 'ERROR', count(*) FILTER (coalesce(n.n, 0) <> 22), count(*) FROM (SELECT 1 AS term) LEFT JOIN n USING (term)
UNION ALL SELECT 'E004', 3, 'WARNING', count(*) FILTER (r.term IS NULL), count(*) FROM grid LEFT JOIN (SELECT DISTINCT term, lesson FROM rec WHERE len(list_filter(images, lambda x: trim(x) <> '')) > 0) r USING (term, lesson) WHERE term = 1 AND lesson <= 9
UNION ALL SELECT 'X011', 1, 'INFO', count(*) FILTER (t.term IS NULL), count(*) FROM (SELECT DISTINCT term, lesson FROM rec) LEFT JOIN (SELECT DISTINCT term, lesson FROM rec WHERE page_id % 4 < 3) t USING (term, lesson)
UNION ALL SELECT 'E008', 3, 'INFO', count(*) FILTER (t.term IS NULL), count(*) FROM grid LEFT JOIN (SELECT DISTINCT term, lesson FROM rec WHERE page_id % 4 < 3) t USING (term, lesson) WHERE term = 3
UNION ALL SELECT 'R004', 1, 'WARNING', CASE WHEN sum(CASE WHEN page_id % 3 = 0 THEN 0 ELSE len(resources) END) < 0.8 * sum(len(resources)) THEN 1 ELSE 0 END, 1 FROM rec
UNION ALL SELECT 'R006', 1, 'INFO', CASE WHEN 100 * avg(CASE WHEN title <> '' AND page_id % 3 <> 0 THEN 1 ELSE 0 END) < 100 * avg(CASE WHEN title <> '' THEN 1 ELSE 0 END) - 1 THEN 1 ELSE 0 END, 1 FROM rec)
SELECT *, failures = 0 AS passed FROM c
"""


@query(_GROUPS)
def q_group_checks(spark, sf_dir):
    """Checks of groups: counts against a profile, gaps, positions, equal titles, constant metadata, common words, times, sums. The records are read once for each grain:
    (term, lesson), titles and words; the checks of the first come from one written summary."""
    rec, i = page_records(spark, sf_dir), F.col("page_id")
    prof = spark.createDataFrame([(1, 60), (2, 60), (3, 60), (5, 10)], "term int, lessons int")
    grid = prof.select("term", F.explode(F.sequence(F.lit(1), F.col("lessons"))).alias("lesson"))
    named = F.nullif(F.regexp_extract("title", r"(?i)lesson\s+(\d{1,9})", 1), F.lit("")).cast("int")
    images = F.exists("images", lambda x: F.trim(x["image_path"]) != "")
    late = F.coalesce(F.try_to_timestamp("generated_at") < F.lit("2024-03-04 00:00:00").cast("timestamp"), F.lit(True))
    marks = {"misnamed": named != F.col("lesson"), "arabic": F.col("title").rlike("[\\u0600-\\u06FF]"), "late": late, "pictured": images, "illustrated": F.size("images") > 0, "template": i % 4 < 3, "titled": F.col("title") != "", "still_titled": (F.col("title") != "") & (i % 3 != 0)}
    links = F.size("resources")
    fields = ("grade_band", "pipeline_version")
    table = saved(spark)(checks.summary(rec, "term", "lesson", fields, marks, {"links": links, "links_left": F.when(i % 3 != 0, links).otherwise(0)}))
    g = checks.GroupChecks(table, "term", "lesson", prof, "lessons")
    parts = [
        g.counts("X001"),
        g.counts("E003", 3),
        g.counts("E005", 3, only=F.col("term") == 2),
        g.counts("I004", 3, only=F.col("term") < 5),
        checks.GroupChecks(table, "term", "lesson", spark.createDataFrame([(1, 22)], "term int, lessons int"), "lessons").counts("B003", 3),
        g.present(grid, "X002", layer=1),
        g.present(prof.select("term"), "E002"),
        g.present(grid.where("term = 1 and lesson <= 9"), "E004", "WARNING", mark="pictured"),
        g.present(table.select("term", "lesson"), "X011", "INFO", 1, "template"),
        g.present(grid.where("term = 3"), "E008", "INFO", mark="template"),
        g.contiguous(),
        g.in_position(),
        g.rows("misnamed", "UN03", "WARNING", "titles name their own number", 4),
        g.constant(fields),
        g.declared(),
        g.some("arabic"),
        g.rows("late", "X008", "INFO", "built after the last change"),
        g.content(prof.where("term <> 2").select("term"), "illustrated"),
        g.not_down("links_left", "links"),
        g.share_not_down("still_titled", "titled"),
        checks.same_across(rec, "term", "lesson", "title"),
        checks.common_values(rec, "keywords", 0.2, rows=table.agg(F.sum("rows")).scalar()),
        checks.parses(read(spark, sf_dir, "events"), "props"),
        checks.required_columns(rec, ["term", "title", "curriculum"], "S001"),
        checks.column_type(rec, "resources", "array<string>", "S010"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return plain(out)


@query("""
WITH g AS (SELECT source, lang, count(*) AS documents, count(*) FILTER (n_chars > 1000) AS links, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS images FROM documents GROUP BY ALL),
u AS (SELECT d.source, d.lang, count(*) AS up_documents, count(*) AS up_links, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS up_images FROM documents d JOIN labels USING (doc_id) GROUP BY ALL),
j AS (SELECT links, images, coalesce(up_documents, 0) AS ud, coalesce(up_links, 0) AS ul, coalesce(up_images, 0) AS ui FROM g LEFT JOIN u USING (source, lang)),
c AS (SELECT 'X003' AS check_id, 1 AS layer, 'WARNING' AS severity, count(*) FILTER (ul > 0 AND links = 0) AS failures, count(*) AS total FROM j UNION ALL SELECT 'X004', 1, 'WARNING', count(*) FILTER (abs(images - ui) > greatest(0.2 * ui, 3.0)), count(*) FROM j UNION ALL SELECT 'X010', 1, 'ERROR', count(*) FILTER (ud <= 0), count(*) FROM j)
SELECT *, failures = 0 AS passed FROM c
""")
def q_upstream_checks(spark, sf_dir):
    """Groups of documents against the labelled documents upstream: links lost, image counts, documents."""
    d, lab = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels").select("doc_id")
    lines = F.coalesce(F.sum(F.size(F.split("text", "\n"))), F.lit(0))
    g = d.groupBy("source", "lang").agg(F.count("*").alias("documents"), F.count_if(F.col("n_chars") > 1000).alias("links"), lines.alias("images"))
    u = d.join(lab, "doc_id").groupBy("source", "lang").agg(F.count("*").alias("documents"), F.count("*").alias("links"), lines.alias("images"))
    return plain(checks.against_upstream(g, u, ["source", "lang"]))


_ITEMS = """
items AS (SELECT doc_id AS item, source || '/' || CASE WHEN doc_id % 13 = 0 THEN 'Exampler ' WHEN doc_id % 5 = 0 THEN 'teacher guide ' ELSE 'Lesson ' END || (doc_id % 50) AS path, CASE WHEN doc_id % 3 = 0 THEN [] ELSE [doc_id % 12 + 1] END AS keys,
  CAST(doc_id % 101 AS DOUBLE) AS confidence, md5(text) AS content_md5, CASE WHEN doc_id % 4 = 0 THEN 'image' WHEN doc_id % 4 = 1 THEN 'video' ELSE 'text' END AS kind, lang AS content_type, CASE WHEN doc_id % 101 >= 90 THEN 'high' WHEN doc_id % 101 >= 70 THEN 'medium' WHEN doc_id % 101 >= 50 THEN 'low' ELSE 'review' END AS status FROM documents),
anom AS (SELECT 'ORPHANED' AS type, 'WARNING' AS severity, item FROM items WHERE len(keys) = 0 AND NOT contains(lower(path), 'teacher guide') UNION ALL SELECT 'MISALIGNED', 'WARNING', item FROM items WHERE confidence > 0 AND confidence < 60
  UNION ALL SELECT 'NAMING_INCONSISTENT', 'INFO', min(item) FROM items WHERE contains(lower(path), 'exampler') GROUP BY path UNION ALL SELECT 'DUPLICATE', 'INFO', item FROM (SELECT item, min(item) OVER (PARTITION BY content_md5) AS f FROM items WHERE content_md5 IS NOT NULL) WHERE item <> f)
"""


def items(spark, sf_dir):
    """Mapped items made from documents: path, keys, confidence, kind."""
    i = F.col("doc_id")
    name = F.when(i % 13 == 0, "Exampler ").when(i % 5 == 0, "teacher guide ").otherwise("Lesson ")
    c = i % 101
    return read(spark, sf_dir, "documents").select(
        i.alias("item"),
        F.concat("source", F.lit("/"), name, (i % 50).cast("string")).alias("path"),
        F.when(i % 3 == 0, F.array().cast("array<bigint>")).otherwise(F.array(i % 12 + 1)).alias("keys"),
        c.cast("double").alias("confidence"),
        F.md5("text").alias("content_md5"),
        F.when(i % 4 == 0, "image").when(i % 4 == 1, "video").otherwise("text").alias("kind"),
        F.col("lang").alias("content_type"),
        F.when(c >= 90, "high").when(c >= 70, "medium").when(c >= 50, "low").otherwise("review").alias("status"),
    )


def found_anomalies(spark, sf_dir):
    return checks.anomalies(items(spark, sf_dir), "teacher guide", "exampler")


@query(f"WITH {_ITEMS} SELECT * FROM anom")
def q_anomalies(spark, sf_dir):
    """Orphaned, misaligned, misspelt and duplicate items."""
    return found_anomalies(spark, sf_dir)


@query(f"""
WITH {_ITEMS}, n AS (SELECT count(*) FILTER (severity = 'ERROR') AS errors, count(*) FILTER (severity = 'WARNING') AS warnings, count(*) AS anomalies FROM anom),
c AS (SELECT *, greatest(0.0, round(least(100.0, 12 / 12 * 100) - least(errors * 5, 30) - least(warnings, 10), 1)) AS confidence FROM n)
SELECT *, CASE WHEN confidence >= 90 AND errors = 0 THEN 'VALID' WHEN confidence >= 80 AND errors <= 2 THEN 'VALID_WITH_WARNINGS' WHEN confidence >= 60 THEN 'NEEDS_REVIEW' ELSE 'INCOMPLETE' END AS status, errors > 0 AS publish_blocked FROM c
""")
def q_validation_status(spark, sf_dir):
    return scores.validation_status(found_anomalies(spark, sf_dir), 12)


_MAP = f"""
WITH {_ITEMS}, m AS (SELECT count(*) AS total, count(*) FILTER (len(keys) > 0) AS mapped, sum(CASE status WHEN 'high' THEN 1.0 WHEN 'medium' THEN 0.85 WHEN 'low' THEN 0.6 ELSE 0 END) AS q FROM items),
a AS (SELECT count(*) FILTER (severity = 'ERROR') AS errors, count(*) FILTER (severity = 'WARNING') AS warnings FROM anom),
conf AS (SELECT total, mapped, errors, warnings, greatest(0.0, least(100.0, round((CAST(0.3 AS DOUBLE) * (mapped / total) + CAST(0.7 AS DOUBLE) * (CAST(q AS DOUBLE) / total) - least(errors * CAST(0.03 AS DOUBLE), 0.15::DOUBLE) - least(warnings * CAST(0.005 AS DOUBLE), 0.05::DOUBLE)) * CAST(100 AS DOUBLE), 1))) AS confidence FROM m, a)
"""


@query(_MAP + "SELECT * FROM conf")
def q_mapping_confidence(spark, sf_dir):
    return scores.mapping_confidence(items(spark, sf_dir), found_anomalies(spark, sf_dir))


@query(f"""
WITH {_ITEMS}, e AS (SELECT unnest(keys) AS key, kind, confidence, content_type FROM items),
g AS (SELECT key, count(*) AS items, count(*) FILTER (kind = 'image') AS image, count(*) FILTER (kind = 'video') AS video, count(*) FILTER (kind = 'text') AS text, avg(confidence) AS mean, string_agg(DISTINCT content_type, ',' ORDER BY content_type) AS content_types FROM e GROUP BY key)
SELECT k.key, coalesce(items, 0) AS items, coalesce(image, 0) AS image, coalesce(video, 0) AS video, coalesce(text, 0) AS text, round(coalesce(mean, 0.0), 1) AS avg_confidence,
  CASE WHEN coalesce(mean, 0) >= 90 THEN 'VALID' WHEN coalesce(mean, 0) >= 70 THEN 'VALID_WITH_WARNINGS' WHEN coalesce(mean, 0) >= 50 THEN 'NEEDS_REVIEW' ELSE 'INCOMPLETE' END AS status, coalesce(content_types, '') AS content_types
FROM (SELECT unnest(range(1, 15)) AS key) k LEFT JOIN g USING (key)
""")
def q_key_inventory(spark, sf_dir):
    """Items of every expected key, with mean confidence and status."""
    inv = scores.key_inventory(items(spark, sf_dir), spark.range(1, 15).select(F.col("id").alias("key")), "key", ["image", "video", "text"])
    return inv.withColumn("content_types", F.array_join("content_types", ","))


@query(_MAP + """
SELECT (SELECT min(n) > 0 FROM (SELECT count(i.key) AS n FROM (SELECT unnest(range(1, 15)) AS key) k LEFT JOIN (SELECT unnest(keys) AS key FROM items) i USING (key) GROUP BY k.key)) AS all_covered, confidence >= 90 AS confidence_90, errors = 0 AS no_errors,
  (SELECT count(*) >= 40 FROM (SELECT unnest(keys) AS key, kind FROM items) WHERE kind = 'image' AND key BETWEEN 1 AND 14) AS images, (SELECT count(*) >= 3 FROM (SELECT unnest(keys) AS key, kind FROM items) WHERE kind = 'video' AND key BETWEEN 1 AND 14) AS videos FROM conf
""")
def q_success_criteria(spark, sf_dir):
    it = items(spark, sf_dir)
    inv = scores.key_inventory(it, spark.range(1, 15).select(F.col("id").alias("key")), "key", ["image", "video", "text"])
    one = scores.mapping_confidence(it, found_anomalies(spark, sf_dir))
    inv = inv.withColumns({"conf": one.select("confidence").scalar(), "errs": one.select("errors").scalar()})
    return scores.success_criteria(inv, F.col("conf"), F.col("errs"), {"images": ("image", 40), "videos": ("video", 3)})


_VERDICTS = "v AS (SELECT doc_id AS record, f.field, f.tier, CASE (doc_id * f.tier) % 5 WHEN 0 THEN 'INCORRECT' WHEN 1 THEN 'PARTIAL' WHEN 2 THEN 'N/A' ELSE 'CORRECT' END AS verdict, doc_id % 4 <> 0 AS consensus FROM labels, (VALUES ('title', 1), ('topics', 2), ('keywords', 3)) f(field, tier))"


def verdicts(spark, sf_dir):
    fields = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.lit(t).alias("tier")) for f, t in (("title", 1), ("topics", 2), ("keywords", 3))])).alias("f")
    k = (F.col("record") * F.col("tier")) % 5
    verdict = F.when(k == 0, "INCORRECT").when(k == 1, "PARTIAL").when(k == 2, "N/A").otherwise("CORRECT")
    rows = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("record"), fields).select("record", "f.field", "f.tier")
    return rows.select("*", verdict.alias("verdict"), (F.col("record") % 4 != 0).alias("consensus"))


@query(f"""
WITH {_VERDICTS}, r AS (SELECT bool_and(consensus) AS agreed FROM v GROUP BY record), t AS (SELECT coalesce(avg(CASE verdict WHEN 'CORRECT' THEN 1.0 WHEN 'PARTIAL' THEN 0.5 ELSE 0.0 END) FILTER (tier = 1 AND verdict <> 'N/A'), 0.0) AS t1, count(*) FILTER (tier = 1 AND verdict = 'INCORRECT') AS bad FROM v)
SELECT (SELECT coalesce(round(avg(CAST(agreed AS INTEGER)), 3), 0) FROM r) AS consensus_rate, round(t1, 3) AS tier1, bad AS tier1_incorrect, CASE WHEN t1 >= 0.95 AND bad = 0 THEN 'PASS' WHEN t1 >= 0.5 THEN 'NEEDS_REVIEW' ELSE 'FAIL' END AS verdict FROM t
""")
def q_judged_summary(spark, sf_dir):
    return scores.judged(verdicts(spark, sf_dir), {1: "ERROR", 2: "WARNING", 3: "INFO"})[0]


@query(f"WITH {_VERDICTS} SELECT record, field, tier, CASE tier WHEN 1 THEN 'ERROR' WHEN 2 THEN 'WARNING' ELSE 'INFO' END AS severity, verdict FROM v WHERE verdict NOT IN ('CORRECT', 'N/A')")
def q_judged_failures(spark, sf_dir):
    return scores.judged(verdicts(spark, sf_dir), {1: "ERROR", 2: "WARNING", 3: "INFO"})[1]


@query(f"WITH {_VERDICTS} SELECT field, count(*) FILTER (verdict = 'INCORRECT') AS incorrect, count(*) AS n FROM v GROUP BY field HAVING count(*) FILTER (verdict = 'INCORRECT') > 0.15 * count(*)")
def q_weak_fields(spark, sf_dir):
    return scores.weak_fields(verdicts(spark, sf_dir), 0.15)


_TRIAGE = """
e AS (SELECT doc_id AS id, source AS key, CASE WHEN doc_id % 2 = 0 THEN 'MISSING' ELSE 'OTHER' END AS type, CASE WHEN doc_id % 3 = 0 THEN 'slides' WHEN doc_id % 3 = 1 THEN 'copies' ELSE 'plan' END AS content_type, CASE doc_id % 5 WHEN 0 THEN 'TRUE_POSITIVE' WHEN 1 THEN 'FALSE_POSITIVE' WHEN 2 THEN 'UNCERTAIN' END AS judged FROM documents),
g AS (SELECT source AS key, count(*) AS documents FROM documents JOIN labels USING (doc_id) WHERE quality = 0 GROUP BY 1),
t AS (SELECT e.id, e.key, e.type, e.content_type, e.judged, CASE WHEN type = 'MISSING' AND content_type = 'slides' AND coalesce(documents, 0) > 0 THEN 'FALSE_POSITIVE' WHEN type = 'MISSING' AND content_type = 'copies' THEN 'FALSE_POSITIVE' WHEN judged IN ('TRUE_POSITIVE', 'FALSE_POSITIVE') THEN judged ELSE 'UNCERTAIN' END AS triage FROM e LEFT JOIN g USING (key))
"""


def triage(spark, sf_dir):
    i = F.col("doc_id")
    judged = F.when(i % 5 == 0, "TRUE_POSITIVE").when(i % 5 == 1, "FALSE_POSITIVE").when(i % 5 == 2, "UNCERTAIN")
    d = read(spark, sf_dir, "documents")
    e = d.select(i.alias("id"), F.col("source").alias("key"), F.when(i % 2 == 0, "MISSING").otherwise("OTHER").alias("type"), F.when(i % 3 == 0, "slides").when(i % 3 == 1, "copies").otherwise("plan").alias("content_type"), judged.alias("judged"))
    g = d.join(read(spark, sf_dir, "labels").where("quality = 0").select("doc_id"), "doc_id").groupBy(F.col("source").alias("key")).agg(F.count("*").alias("documents"))
    return scores.triaged(e, g, "key", "slides", "copies")


@query(f"WITH {_TRIAGE} SELECT id, key, type, content_type, judged, triage FROM t")
def q_error_triage(spark, sf_dir):
    return triage(spark, sf_dir).select("id", "key", "type", "content_type", "judged", "triage")


@query(f"""
WITH {_TRIAGE}, {_VERDICTS}, n AS (SELECT count(*) AS n, count(*) FILTER (triage = 'FALSE_POSITIVE') AS fp, count(*) FILTER (triage = 'TRUE_POSITIVE') AS confirmed FROM t), s AS (SELECT avg(CASE verdict WHEN 'CORRECT' THEN 1.0 WHEN 'PARTIAL' THEN 0.5 ELSE 0.0 END) AS mean FROM v)
SELECT n, fp, confirmed, greatest(0.0, round(round(0.7 * mean + 0.3 * fp / n, 2) - least(0.02 * confirmed, 0.2), 2)) AS confidence FROM n, s
""")
def q_combined_confidence(spark, sf_dir):
    return scores.combined_confidence(triage(spark, sf_dir), verdicts(spark, sf_dir).select(scores.verdict_score(F.col("verdict")).alias("score")))


@query(f"WITH {REC}, b AS ({_rows(_BOUNDS, {'B002_videos': 1, 'B002_tools': 1, 'B006': 1})}) SELECT layer, severity, count(*) AS checks, count(*) FILTER (NOT passed) AS failed, coalesce(array_to_string(list_slice(list_sort(list(DISTINCT check_id) FILTER (NOT passed)), 1, 5), ','), '') AS examples FROM b GROUP BY ALL")
def q_layer_report(spark, sf_dir):
    """Checks by layer and severity with examples of failed ones."""
    return scores.layer_report(q_boundary_checks(spark, sf_dir), "layer").withColumn("examples", F.array_join("examples", ","))


_SRC = f"""
l AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS content, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL),
tg AS (SELECT doc_id * 100000 + i AS id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'speaker_note' ELSE 'text_block' END AS ty, {NORM.replace('text', 'content')} AS norm, CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 2 WHEN 'fr' THEN 3 END AS term, CAST(NULL AS INTEGER) AS lesson FROM l
  UNION ALL SELECT 9000000000 + page_id, 'link', lower(trim(url)), 1, CAST(NULL AS INTEGER) FROM pages WHERE page_id % 10 <> 0
  UNION ALL SELECT 8000000000 + page_id, 'text_block', 'see ' || lower(trim(url)) || ' for more', 2, CAST(NULL AS INTEGER) FROM pages WHERE page_id % 10 = 0),
so AS (SELECT item_id AS id, 'text_block' AS ty, {NORM} AS norm, 1 AS term FROM benchmark UNION ALL SELECT 1000000 + page_id, 'text_block', {NORM.replace('text', "regexp_extract(html, '<title>([^<]*)</title>', 1)")}, 2 FROM pages
  UNION ALL SELECT 2000000 + page_id, 'link', lower(trim(CASE WHEN page_id % 2 = 0 THEN replace(url, 'https://', 'http://') ELSE url || '/' END)), 1 FROM pages
  UNION ALL SELECT 3000000 + page_id, 'video_url', lower(trim(url)), NULL FROM pages WHERE page_id % 10 = 0
  UNION ALL SELECT 4000000 + doc_id, 'speaker_note', {NORM.replace('text', 'substring(text, 5, 60)')}, CASE WHEN doc_id % 2 = 0 THEN 1 END FROM documents WHERE text IS NOT NULL)
"""
_RECON = f"""
WITH {_SRC}, todo AS (SELECT * FROM so WHERE length(norm) >= 5 AND NOT (ty = 'text_block' AND length(norm) <= 60 AND regexp_matches(norm, '^(the|le) '))),
ex AS (SELECT t.id, arg_min(g.id, CASE WHEN g.term IS NOT DISTINCT FROM t.term AND g.lesson IS NULL THEN 0 ELSE 1 END * 100000000000000 + g.id) AS target_id FROM todo t JOIN tg g ON g.norm = t.norm GROUP BY t.id),
r1 AS (SELECT * FROM todo WHERE id NOT IN (SELECT id FROM ex)),
ct AS (SELECT t.id, arg_min(g.id, CASE WHEN g.term IS NOT DISTINCT FROM t.term THEN 0 ELSE 1 END * 1000000000000000 + CASE WHEN g.ty = t.ty THEN 0 ELSE 1 END * 100000000000000 + g.id) AS target_id, max(CASE WHEN g.term IS NOT DISTINCT FROM t.term THEN 0.9 ELSE 0.85 END) AS confidence
  FROM r1 t JOIN tg g ON (g.ty = t.ty OR t.ty = 'speaker_note' AND g.ty = 'text_block') AND length(g.norm) >= 12 AND (contains(g.norm, t.norm) OR contains(t.norm, g.norm)) WHERE length(t.norm) >= 10 GROUP BY t.id),
r2 AS (SELECT * FROM r1 WHERE id NOT IN (SELECT id FROM ct)),
ua AS (SELECT t.id, min(g.id) AS target_id FROM r2 t JOIN tg g ON t.ty IN ('link', 'video_url') AND g.ty IN ('link', 'video_url') AND regexp_replace(g.norm, '/+$', '') = regexp_replace(t.norm, '/+$', '') GROUP BY t.id),
ub AS (SELECT t.id, min(g.id) AS target_id FROM r2 t JOIN tg g ON t.ty IN ('link', 'video_url') AND g.ty IN ('link', 'video_url') AND regexp_replace(regexp_replace(g.norm, '/+$', ''), '^[a-z]+://(www\\.)?', '') = regexp_replace(regexp_replace(t.norm, '/+$', ''), '^[a-z]+://(www\\.)?', '') WHERE t.id NOT IN (SELECT id FROM ua) GROUP BY t.id),
r3 AS (SELECT * FROM r2 WHERE id NOT IN (SELECT id FROM ua) AND id NOT IN (SELECT id FROM ub)),
ut AS (SELECT t.id, min(g.id) AS target_id FROM r3 t JOIN tg g ON t.ty IN ('link', 'video_url') AND g.ty = 'text_block' AND contains(g.norm, regexp_replace(t.norm, '/+$', '')) GROUP BY t.id),
cs AS (SELECT t.id, arg_min(g.id, CASE g.ty WHEN 'text_block' THEN 0 ELSE 1 END * 100000000000000 + g.id) AS target_id FROM r3 t JOIN tg g ON t.ty IN ('text_block', 'speaker_note') AND g.ty IN ('text_block', 'speaker_note') AND g.term IS NOT DISTINCT FROM t.term AND g.norm <> '' AND (contains(g.norm, t.norm) OR contains(t.norm, g.norm)) WHERE length(t.norm) >= 15 GROUP BY t.id),
m AS (SELECT id, target_id, 'exact' AS tier, 1.0 AS confidence FROM ex UNION ALL SELECT id, target_id, 'contains', confidence FROM ct UNION ALL SELECT id, target_id, 'url', 1.0 FROM ua UNION ALL SELECT id, target_id, 'url_loose', 0.95 FROM ub UNION ALL SELECT id, target_id, 'url_in_text', 0.8 FROM ut UNION ALL SELECT id, target_id, 'cross_source', 0.85 FROM cs),
res AS (SELECT s.id AS atom_id, s.ty AS atom_type, s.term, CASE WHEN length(s.norm) < 5 THEN 'trivial' WHEN s.ty = 'text_block' AND length(s.norm) <= 60 AND regexp_matches(s.norm, '^(the|le) ') THEN 'structural' WHEN m.id IS NOT NULL THEN 'matched' ELSE 'unmatched' END AS class, m.tier, m.target_id, CAST(m.confidence AS DOUBLE) AS confidence FROM so s LEFT JOIN m ON m.id = s.id)
"""


def reconciled(spark, sf_dir):
    """Benchmark passages, page titles, changed page urls, page urls as videos and cuts of documents against lines of documents and page urls, alone and inside texts."""
    from ..operators.rollup import lines

    p, no = read(spark, sf_dir, "pages"), F.lit(None).cast("int")
    url = F.when(F.col("page_id") % 2 == 0, F.replace(F.col("url"), F.lit("https://"), F.lit("http://"))).otherwise(F.concat("url", F.lit("/")))
    one = lambda df, i, kind, content, term: df.select(i.alias("atom_id"), F.lit(kind).alias("atom_type"), content.alias("content"), term.alias("term"), no.alias("lesson"), i.alias("ord"))
    d, tenth, i = read(spark, sf_dir, "documents").where("text is not null"), p.where("page_id % 10 = 0"), F.col("page_id")
    source = one(read(spark, sf_dir, "benchmark"), F.col("item_id"), "text_block", F.col("text"), F.lit(1)).union(one(p, i + 1000000, "text_block", F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit(2)))
    source = source.union(one(p, i + 2000000, "link", url, F.lit(1))).union(one(tenth, i + 3000000, "video_url", F.col("url"), no))
    source = source.union(one(d, F.col("doc_id") + 4000000, "speaker_note", F.substring("text", 5, 60), F.when(F.col("doc_id") % 2 == 0, 1)))
    labelled = read(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("note", F.lit(True))
    rows = lines(d).join(d.select("doc_id", "lang"), "doc_id").join(labelled, "doc_id", "left")
    n = F.col("doc_id") * 100000 + F.col("line_no")
    target = rows.select(n.alias("atom_id"), F.when(F.col("note"), "speaker_note").otherwise("text_block").alias("atom_type"), F.col("line").alias("content"), F.when(F.col("lang") == "en", 1).when(F.col("lang") == "de", 2).when(F.col("lang") == "fr", 3).alias("term"), no.alias("lesson"), n.alias("ord"))
    target = target.union(one(p.where("page_id % 10 <> 0"), i + 9000000000, "link", F.col("url"), F.lit(1))).union(one(tenth, i + 8000000000, "text_block", F.concat(F.lit("See "), F.col("url"), F.lit(" for more")), F.lit(2)))
    return source, reconcile.reconcile(source, target, 12, ([], "^(the|le) "))


@query(_RECON + "SELECT atom_id, atom_type, term, class, tier, target_id, confidence FROM res")
def q_reconcile(spark, sf_dir):
    """The cascade of matches, each tier on what the last left over."""
    return reconciled(spark, sf_dir)[1].drop("lesson")


@query(_RECON + "SELECT atom_type, count(*) AS atoms, count(*) FILTER (class IN ('matched', 'structural')) AS matched, count(*) FILTER (class <> 'trivial') AS counted, CASE WHEN count(*) FILTER (class <> 'trivial') = 0 THEN 1.0 ELSE count(*) FILTER (class IN ('matched', 'structural')) / count(*) FILTER (class <> 'trivial') END AS coverage FROM res GROUP BY GROUPING SETS ((atom_type), ())")
def q_reconcile_coverage(spark, sf_dir):
    """Coverage by type of atom and over all."""
    r = saved(spark)(reconciled(spark, sf_dir)[1])
    return reconcile.coverage(r, "atom_type").unionByName(reconcile.coverage(r).withColumn("atom_type", F.lit(None).cast("string")))


@query(_RECON + """
, k AS (SELECT *, CASE WHEN atom_id % 3 = 0 THEN NULL ELSE 1 END AS lesson, atom_type || atom_id % 4 AS source_file, atom_id % 3 AS lost_at FROM res), u AS (SELECT * FROM k WHERE class = 'unmatched'),
c AS (SELECT 'V001' AS check_id, 'ERROR' AS severity, count(*) FILTER (class = 'unmatched' AND lesson IS NOT NULL AND term IS NOT NULL) AS failures, count(*) FILTER (class <> 'trivial' AND lesson IS NOT NULL AND term IS NOT NULL) AS total, 0.05 AS allowed FROM k
UNION ALL SELECT 'V002', 'ERROR', CASE WHEN count(*) FILTER (class IN ('matched', 'unmatched')) = 0 THEN 1 ELSE count(*) FILTER (class = 'unmatched') END, greatest(1, count(*) FILTER (class IN ('matched', 'unmatched'))), 0.1 FROM k WHERE atom_type IN ('link', 'video_url')
UNION ALL SELECT 'V003', 'WARNING', count(*) FILTER (atom_type = 'text_block' AND lost_at IN (1, 2)), count(*), 0 FROM u
UNION ALL SELECT 'V004', 'WARNING', count(*), count(*), 0 FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) >= 7)
UNION ALL SELECT 'V005', 'WARNING', count(DISTINCT source_file), count(DISTINCT source_file), 0 FROM u WHERE lesson IS NULL OR term IS NULL
UNION ALL SELECT 'V006', 'INFO', CASE WHEN count(*) FILTER (class IN ('matched', 'unmatched')) = 0 THEN 1 ELSE count(*) FILTER (class = 'unmatched') END, greatest(1, count(*) FILTER (class IN ('matched', 'unmatched'))), 0.2 FROM k WHERE atom_type = 'speaker_note'
UNION ALL SELECT 'V007', 'WARNING', count(*) FILTER (starts_with(source, 'src1')), count(*), 0 FROM documents
UNION ALL SELECT 'V008', 'WARNING', count(*), count(*), 0 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'V009', 'WARNING', count(*), count(*), 0 FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))
SELECT check_id, 5 AS layer, severity, failures, total, failures <= allowed * total AS passed FROM c
""")
def q_reconcile_checks(spark, sf_dir):
    """The reconciliation checks as check rows."""
    r = reconciled(spark, sf_dir)[1].drop("lesson")
    r = saved(spark)(r.withColumns({"lesson": F.when(F.col("atom_id") % 3 != 0, 1), "source_file": F.concat("atom_type", (F.col("atom_id") % 4).cast("string"))}))
    losses = r.where("class = 'unmatched'").select("atom_type", (F.col("atom_id") % 3).cast("int").alias("lost_at"))
    truncated = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n")).where("n >= 7")
    d, lab = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels").select("doc_id")
    target = d.select(F.when(F.startswith("source", F.lit("src1")), F.concat(F.lit("remaining_content:"), "source")).otherwise(F.col("source")).alias("location"))
    return plain(reconcile.reconcile_checks(r, losses, truncated, target, d.join(lab, "doc_id", "left_anti"), lab.join(d, "doc_id", "left_anti")))


@query(f"""
WITH t AS (SELECT p_brand AS id, {NORM.replace('text', "string_agg(p_name, ' | ' ORDER BY p_partkey)")} AS norm, CAST(substring(p_brand, 7, 1) AS INTEGER) AS term FROM part GROUP BY p_brand), s AS (SELECT p_partkey AS id, {NORM.replace('text', 'p_name')} AS norm, p_size % 5 + 1 AS term FROM part)
SELECT s.id AS atom_id, min(t.id) AS target_id FROM s JOIN t ON s.term = t.term AND contains(t.norm, s.norm) WHERE length(s.norm) >= 10 GROUP BY s.id
""")
def q_table_cells(spark, sf_dir):
    """Part names as cells inside the whole table of a brand."""
    p = read(spark, sf_dir, "part")
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name"))), lambda x: x["p_name"]), " | ")
    none = F.lit(None).cast("int").alias("lesson")
    t = p.groupBy("p_brand").agg(listed.alias("content")).select(F.col("p_brand").alias("atom_id"), F.lit("table").alias("atom_type"), "content", F.substring("p_brand", 7, 1).cast("int").alias("term"), none, F.col("p_brand").alias("ord"))
    s = p.select(F.col("p_partkey").alias("atom_id"), F.lit("table").alias("atom_type"), F.col("p_name").alias("content"), (F.col("p_size") % 5 + 1).alias("term"), none, F.col("p_partkey").alias("ord"))
    return reconcile.match_table_cell(reconcile.prepared(s), reconcile.prepared(t)).select("atom_id", "target_id")


_IMG = "SELECT {0} AS id, lower(trim(url)) || {1} AS url, regexp_extract(url, '://([^/]+)', 1) AS stem, [page_id % 7, page_id % 5 + {2}] AS slides, page_id % 3 AS term, page_id % 11 AS lesson FROM pages"


@query(f"""
WITH s AS ({_IMG.format('page_id', "CASE WHEN page_id % 2 = 0 THEN '' ELSE '#x' END", 0)}), t AS ({_IMG.format('page_id + 5000', "''", '(page_id % 2) * 3')}),
a AS (SELECT s.id, min(t.id) AS target_id FROM s JOIN t ON s.url = t.url GROUP BY s.id), r AS (SELECT * FROM s WHERE id NOT IN (SELECT id FROM a)),
b AS (SELECT r.id, min(t.id) AS target_id FROM r JOIN t ON r.stem = t.stem AND list_sort(r.slides) = list_sort(t.slides) WHERE r.stem <> '' GROUP BY r.id), q AS (SELECT * FROM r WHERE id NOT IN (SELECT id FROM b)),
c AS (SELECT q.id, min(t.id) AS target_id FROM q JOIN t ON q.term = t.term AND q.lesson = t.lesson AND list_has_any(q.slides, t.slides) GROUP BY q.id)
SELECT id AS atom_id, target_id, 'image_url' AS tier, CAST(1.0 AS DOUBLE) AS confidence FROM a UNION ALL SELECT id, target_id, 'image', 0.95 FROM b UNION ALL SELECT id, target_id, 'image_slides', 0.85 FROM c
""")
def q_image_refs(spark, sf_dir):
    """Image references by url, by stem and slides, by overlapping slides of one key."""
    p, i = read(spark, sf_dir, "pages"), F.col("page_id")
    of = lambda key, url, plus: p.select(key.alias("atom_id"), url.alias("content"), F.regexp_extract("url", "://([^/]+)", 1).alias("stem"), F.array(i % 7, i % 5 + plus).alias("slides"), (i % 3).alias("term"), (i % 11).alias("lesson"))
    s = of(i, F.concat(F.lower(F.trim("url")), F.when(i % 2 == 0, "").otherwise("#X")), F.lit(0))
    return reconcile.match_image_ref(s, of(i + 5000, F.concat(F.lit(" "), F.col("url")), (i % 2) * 3))


@query(_RECON + "SELECT lost_at, atom_type, count(*) AS n, CASE lost_at WHEN 'convert' THEN 'convert again' ELSE 'inspect the output' END AS advice FROM (SELECT atom_type, CASE WHEN atom_id % 2 = 0 THEN 'convert' ELSE 'build' END AS lost_at FROM res WHERE class = 'unmatched') GROUP BY lost_at, atom_type")
def q_fix_suggestions(spark, sf_dir):
    lost = reconciled(spark, sf_dir)[1].where("class = 'unmatched'").select("atom_type", F.when(F.col("atom_id") % 2 == 0, "convert").otherwise("build").alias("lost_at"))
    return scores.fix_suggestions(lost, {"convert": "convert again"})


@query(f"""
WITH {REC}, t AS (SELECT DISTINCT term AS g, lower(trim(unnest(topics))) AS m FROM rec), z AS (SELECT g, count(*) AS n FROM t GROUP BY g)
SELECT a.g AS a, b.g AS b, (SELECT count(*) FROM t x JOIN t y ON x.m = y.m WHERE x.g = a.g AND y.g = b.g) AS shared,
  (SELECT count(*) FROM t x JOIN t y ON x.m = y.m WHERE x.g = a.g AND y.g = b.g) / (a.n + b.n - (SELECT count(*) FROM t x JOIN t y ON x.m = y.m WHERE x.g = a.g AND y.g = b.g)) AS jaccard FROM z a JOIN z b ON a.g < b.g
""")
def q_topic_overlap(spark, sf_dir):
    """Jaccard of the topics of each two groups of records."""
    t = page_records(spark, sf_dir).select("term", F.explode("topics").alias("topic")).select("term", F.lower(F.trim("topic")).alias("topic"))
    return rollup.set_overlap(t, "term", "topic")

