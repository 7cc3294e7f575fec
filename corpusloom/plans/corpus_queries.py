"""More queries over the driver's tables: keys, lookups, links, votes, scores, sets, text functions, records and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as T
from ..operators import dedup, diff, reconcile, records, rollup, tallies
from ..operators.expect import completeness
from ..operators.scores import verdict_score
from ..operators.similar import match_fuzzy
from ..session import checkpointed, shared_dir
from ..streaming import feeds
from .queries import PAGE_RULES, query, read

LESSONS = R.KeyRules({"src1": 1, "src2": 2, "src3": 3}, {"src": 1}, "lesson", {1: 24, 2: 14, 3: 24}, {i: [2 * i - 1, 2 * i] for i in range(1, 7)})

#: Paths made from documents: a folder, then one lesson, a range, a week or nothing.
_PATHS = """
SELECT doc_id, source || CASE WHEN doc_id % 4 = 0 THEN '/Lesson ' || (doc_id % 30) WHEN doc_id % 4 = 1 THEN '/Lessons ' || (doc_id % 20) || '-' || (doc_id % 20 + 2) WHEN doc_id % 4 = 2 THEN '/Week ' || (doc_id % 8) ELSE '/misc' END || '/file.txt' AS path FROM documents
"""


def doc_paths(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    i, n = F.col("doc_id"), lambda k, plus=0: (F.col("doc_id") % k + plus).cast("string")
    part = F.when(i % 4 == 0, F.concat(F.lit("/Lesson "), n(30))).when(i % 4 == 1, F.concat(F.lit("/Lessons "), n(20), F.lit("-"), n(20, 2))).when(i % 4 == 2, F.concat(F.lit("/Week "), n(8))).otherwise("/misc")
    return d.select("doc_id", F.concat("source", part, F.lit("/file.txt")).alias("path"))


_KEYS = f"""
WITH p AS ({_PATHS}), g AS (SELECT doc_id, lower(path) AS path, CASE WHEN starts_with(path, 'src1/') THEN 1 WHEN starts_with(path, 'src2/') THEN 2 WHEN starts_with(path, 'src3/') THEN 3 ELSE 1 END AS grp FROM p),
m AS (SELECT *, CASE WHEN grp = 2 THEN 14 ELSE 24 END AS most, TRY_CAST(regexp_extract(path, 'lesson[_\\s\\-]*(\\d{{1,2}})', 1) AS INTEGER) AS one, TRY_CAST(regexp_extract(path, 'lessons?\\s*(\\d{{1,2}})\\s*-\\s*(\\d{{1,2}})', 1) AS INTEGER) AS lo,
  TRY_CAST(regexp_extract(path, 'lessons?\\s*(\\d{{1,2}})\\s*-\\s*(\\d{{1,2}})', 2) AS INTEGER) AS hi, TRY_CAST(regexp_extract(path, 'week[_\\s\\-]*(\\d)', 1) AS INTEGER) AS week FROM g),
k AS (SELECT doc_id, grp, CASE WHEN one BETWEEN 1 AND most THEN [one] WHEN lo BETWEEN 1 AND most AND hi BETWEEN 1 AND most AND lo <= hi THEN range(lo, hi + 1) WHEN week BETWEEN 1 AND 6 THEN [2 * week - 1, 2 * week] ELSE [] END AS keys FROM m)
"""


def doc_keys(spark, sf_dir):
    g = doc_paths(spark, sf_dir).withColumn("grp", R.group_of(F.col("path"), LESSONS))
    return g.select("doc_id", "grp", R.keys_of(F.col("path"), F.col("grp"), LESSONS).alias("keys"))


@query(_KEYS + "SELECT doc_id, grp, array_to_string(keys, ',') AS keys FROM k")
def q_keys_from_path(spark, sf_dir):
    return doc_keys(spark, sf_dir).withColumn("keys", F.array_join(F.col("keys").cast("array<string>"), ","))


@query(_KEYS + "SELECT grp, key, count(*) AS docs FROM (SELECT grp, unnest(keys) AS key FROM k) GROUP BY ALL")
def q_explode_keys(spark, sf_dir):
    return doc_keys(spark, sf_dir).where("grp is not null").select("grp", F.explode("keys").alias("key")).groupBy("grp", "key").agg(F.count("*").alias("docs"))


@query(_KEYS + "SELECT key, count(*) AS docs FROM (SELECT unnest(CASE WHEN len(keys) BETWEEN 1 AND 2 THEN keys ELSE [NULL] END) AS key FROM k) GROUP BY ALL")
def q_collapse_wide_keys(spark, sf_dir):
    return doc_keys(spark, sf_dir).select(F.explode(R.collapse_wide(F.col("keys"), 2)).alias("key")).groupBy("key").agg(F.count("*").alias("docs"))


@query(_KEYS + "SELECT doc_id FROM k WHERE len(keys) = 0 OR grp IS NULL")
def q_unassigned(spark, sf_dir):
    return doc_keys(spark, sf_dir).where("size(keys) = 0 or grp is null").select("doc_id")


@query(_KEYS + "SELECT doc_id, CAST(len(keys) AS INTEGER) AS n FROM k WHERE len(keys) > 2")
def q_over_assigned(spark, sf_dir):
    return dedup.over_assigned(doc_keys(spark, sf_dir).withColumn("path", F.lit("")), "keys", "path").select("doc_id", F.size("keys").alias("n"))


@query("SELECT doc_id, CASE WHEN regexp_matches(lower(source), '^src1$') THEN NULL WHEN regexp_matches(lower(source), '^src1') THEN 'first' WHEN regexp_matches(lower(source), '[02468]$') THEN 'even' END AS kind FROM documents")
def q_classify_rules(spark, sf_dir):
    """A veto, then the first pattern that matches."""
    return read(spark, sf_dir, "documents").select("doc_id", R.classify(F.col("source"), "^src1$", [("^src1", "first"), ("[02468]$", "even")]).alias("kind"))


@query("SELECT d.doc_id, coalesce(m.category, 'content') AS category FROM documents d LEFT JOIN (SELECT doc_id, CASE WHEN quality = 0 THEN 'admin' ELSE 'media' END AS category FROM labels WHERE quality = 0 OR toxic = 1) m USING (doc_id) WHERE coalesce(m.category, 'content') <> 'admin'")
def q_exclude_by_manifest(spark, sf_dir):
    m = read(spark, sf_dir, "labels").where("quality = 0 or toxic = 1").select("doc_id", F.when(F.col("quality") == 0, "admin").otherwise("media").alias("category"))
    return tallies.without_category(read(spark, sf_dir, "documents").select("doc_id"), m, "doc_id", "content", ["admin"])


@query("""
SELECT p.page_id, coalesce(a.key, b.key, c.key) AS key, CASE WHEN a.key IS NOT NULL THEN 'url' WHEN b.key IS NOT NULL THEN 'host' WHEN c.key IS NOT NULL THEN 'lang' END AS how FROM pages p
LEFT JOIN (SELECT url AS u, min(page_id) AS key FROM pages WHERE page_id % 3 = 0 GROUP BY url) a ON a.u = p.url
LEFT JOIN (SELECT regexp_extract(url, '://([^/]+)', 1) AS u, min(page_id) AS key FROM pages WHERE page_id % 3 = 0 GROUP BY 1) b ON b.u = regexp_extract(p.url, '://([^/]+)', 1)
LEFT JOIN (SELECT regexp_extract(url, '/(en|de|fr|es)/', 1) AS u, min(page_id) AS key FROM pages WHERE page_id % 3 = 0 GROUP BY 1) c ON c.u = regexp_extract(p.url, '/(en|de|fr|es)/', 1)
""")
def q_cascade_lookup(spark, sf_dir):
    """The first of three lookups that knows a page: its url, its host, its language."""
    p = read(spark, sf_dir, "pages").select("page_id", "url", F.regexp_extract("url", "://([^/]+)", 1).alias("host"), F.regexp_extract("url", "/(en|de|fr|es)/", 1).alias("lang"))
    out = tallies.cascade_lookup(p, p.where("page_id % 3 = 0"), ["url", "host", "lang"], "page_id")
    return out.select("page_id", F.col("found").alias("key"), "how")


@query(r"""
WITH u AS (SELECT page_id, regexp_replace(lower(trim(url)), '/+$', '') AS a, regexp_replace(regexp_replace(lower(trim(url)), '/+$', ''), '^[a-z]+://(www\.)?', '') AS b FROM pages),
t AS (SELECT page_id AS target_id, regexp_replace(lower(trim(upper(replace(url, 'https://', CASE WHEN page_id % 2 = 0 THEN 'http://' ELSE 'https://' END)) || '/')), '/+$', '') AS x FROM pages WHERE page_id % 5 <> 0),
e AS (SELECT u.page_id, min(target_id) AS target_id FROM u JOIN t ON t.x = u.a GROUP BY 1),
f AS (SELECT u.page_id, min(target_id) AS target_id FROM u JOIN t ON regexp_replace(t.x, '^[a-z]+://(www\.)?', '') = u.b WHERE u.page_id NOT IN (SELECT page_id FROM e) GROUP BY 1)
SELECT page_id, target_id, 'url' AS tier FROM e UNION ALL SELECT page_id, target_id, 'url_loose' FROM f
""")
def q_match_url(spark, sf_dir):
    """Page urls against upper-cased copies with a closing slash, of which half lost their scheme's s."""
    p = read(spark, sf_dir, "pages")
    s = p.select(F.col("page_id").alias("atom_id"), F.col("url").alias("content"))
    scheme = F.when(F.col("page_id") % 2 == 0, "http://").otherwise("https://")
    t = p.where("page_id % 5 <> 0").select(F.col("page_id").alias("atom_id"), F.concat(F.upper(F.replace(F.col("url"), F.lit("https://"), scheme)), F.lit("/")).alias("content"), F.col("page_id").alias("ord"))
    return reconcile.match_url(s, t).select(F.col("atom_id").alias("page_id"), "target_id", "tier")


@query("""
WITH a AS (SELECT o_custkey AS k, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o FROM orders GROUP BY 1)
SELECT k, f, o FROM a WHERE abs(f - o) > 5
""")
def q_pair_mismatch(spark, sf_dir):
    """Keys whose counts of two kinds differ by more than five."""
    out = tallies.pair_mismatch(read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), "o_orderstatus"), "k", "o_orderstatus", "F", "O", 5)
    return out.select("k", F.col("first").alias("f"), F.col("second").alias("o"))


@query("""
WITH g AS (SELECT source, count(*) AS docs, avg(n_chars) AS mean FROM documents GROUP BY source), l AS (SELECT d.source, count(*) AS labelled FROM labels JOIN documents d USING (doc_id) GROUP BY 1)
SELECT g.source, docs, coalesce(labelled, 0) AS labelled, abs(coalesce(labelled, 0) - docs * 0.4) > greatest(docs * 0.4 * 0.2, 3) AS off FROM g LEFT JOIN l USING (source)
""")
def q_group_compare(spark, sf_dir):
    """Groups of one table against groups of another, within a fifth or three."""
    d = read(spark, sf_dir, "documents")
    lab = d.join(read(spark, sf_dir, "labels"), "doc_id").groupBy("source").agg(F.count("*").alias("labelled"))
    return tallies.group_compare(d.groupBy("source").agg(F.count("*").alias("docs")), lab, "source", "docs", "labelled", 0.4, 0.2, 3)


@query("SELECT o_custkey AS k, count(*) AS n, sha256(string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey)) AS items FROM orders GROUP BY 1")
def q_group_items(spark, sf_dir):
    """Counts and ordered items of each key."""
    items = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("ord"), F.lit("order").alias("kind"))
    out = records.grouped(items, ["k"], "ord", ["order"])
    return out.select("k", F.col("order_count").alias("n"), F.sha2(F.array_join(F.transform("order", lambda x: x["ord"].cast("string")), ","), 256).alias("items"))


@query("SELECT 'document' AS kind, count(*) AS n FROM documents UNION ALL SELECT 'page', count(*) FROM pages UNION ALL SELECT 'turn', count(*) FROM conversations UNION ALL SELECT 'item', count(*) FROM benchmark")
def q_run_totals(spark, sf_dir):
    one = lambda t, k: read(spark, sf_dir, t).select(F.lit(k).alias("kind"))
    return one("documents", "document").union(one("pages", "page")).union(one("conversations", "turn")).union(one("benchmark", "item")).groupBy("kind").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, count(*) AS n, count(*) >= 7 AS cut FROM lineitem GROUP BY 1 HAVING count(*) >= 7")
def q_truncation(spark, sf_dir):
    """Groups that reach a limit and so may have been cut."""
    return tallies.at_limit(read(spark, sf_dir, "lineitem"), "l_orderkey", 7)


@query("""
WITH c AS (SELECT lang, 100 * avg(CASE WHEN n_chars >= 500 THEN 1 ELSE 0 END) AS conf FROM documents GROUP BY lang)
SELECT lang, round(conf, 6) AS confidence, CASE WHEN conf >= 90 THEN 'high' WHEN conf >= 70 THEN 'medium' WHEN conf >= 50 THEN 'low' ELSE 'review' END AS band FROM c
""")
def q_confidence_bands(spark, sf_dir):
    c = read(spark, sf_dir, "documents").groupBy("lang").agg((100 * F.avg(F.when(F.col("n_chars") >= 500, 1).otherwise(0))).alias("c"))
    return c.select("lang", F.round("c", 6).alias("confidence"), tallies.confidence_band(F.col("c")).alias("band"))


@query("""
SELECT tier, round(avg(score), 9) AS score, count(*) AS n FROM (SELECT CASE WHEN d.lang = 'en' THEN 'critical' WHEN d.lang = 'de' THEN 'important' ELSE 'other' END AS tier,
  CASE WHEN quality = 1 AND toxic = 0 THEN 1.0 WHEN quality = 1 THEN 0.5 ELSE 0.0 END AS score FROM labels JOIN documents d USING (doc_id)) GROUP BY tier
""")
def q_tier_scores(spark, sf_dir):
    """Mean verdict scores by tier."""
    j = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents"), "doc_id")
    tier = F.when(F.col("lang") == "en", "critical").when(F.col("lang") == "de", "important").otherwise("other")
    verdict = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "CORRECT").when(F.col("quality") == 1, "PARTIAL").otherwise("INCORRECT")
    return tallies.tier_scores(j, tier, verdict_score(verdict))


@query("SELECT lang, count(*) FILTER (quality = 1) AS good, count(*) FILTER (quality = 0) AS bad, round(avg(quality), 9) AS rate FROM labels JOIN documents USING (doc_id) GROUP BY lang")
def q_field_accuracy(spark, sf_dir):
    j = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return tallies.field_accuracy(j, "lang", F.col("quality") == 1)


@query("SELECT source, count(*) AS docs, count(DISTINCT text) AS texts, count(DISTINCT text) BETWEEN count(*) * (1 - 0.05) AND count(*) * (1 + 0.05) AS ok FROM documents GROUP BY source")
def q_within_tolerance(spark, sf_dir):
    """Whether the number of different texts is within a twentieth of the number of documents."""
    n = read(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("docs"), F.count_distinct("text").alias("texts"))
    return n.withColumn("ok", diff.within(F.col("texts"), F.col("docs"), 0.05))


@query("(SELECT doc_id FROM documents WHERE lang = 'en' EXCEPT SELECT doc_id FROM labels) UNION (SELECT doc_id FROM documents WHERE lang = 'de' INTERSECT SELECT doc_id FROM labels)")
def q_set_operations(spark, sf_dir):
    d, lab = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels").select("doc_id")
    return d.where("lang = 'en'").select("doc_id").subtract(lab).union(d.where("lang = 'de'").select("doc_id").intersect(lab)).distinct()


@query("SELECT c_custkey, lower(regexp_replace(regexp_replace(regexp_replace(c_name, '[^A-Za-z0-9]+', '-', 'g'), '^-+', ''), '-+$', '')) AS slug, CASE WHEN regexp_matches(trim(c_name), '[.!?:)]$') THEN trim(c_name) ELSE trim(c_name) || '.' END AS line, CASE WHEN length(c_name) > 10 THEN substring(c_name, 1, 10) || '...' ELSE c_name END AS cut FROM customer")
def q_text_forms(spark, sf_dir):
    n = F.col("c_name")
    return read(spark, sf_dir, "customer").select("c_custkey", T.slug(n).alias("slug"), T.punctuated(n).alias("line"), T.capped(n, 10).alias("cut"))


@query(r"SELECT doc_id, coalesce(array_to_string(list_sort(list_distinct(list_filter([CASE WHEN regexp_matches(text, '(?i)\bidiot\b') THEN 'insult' END, CASE WHEN regexp_matches(text, '(?i)\bclown\b') THEN 'insult' END, CASE WHEN regexp_matches(text, '(?i)\bpassword\b') THEN 'secret' END], lambda x: x IS NOT NULL))), ','), '') AS tags FROM documents")
def q_keyword_tags(spark, sf_dir):
    """Canonical tags of key words, on word boundaries."""
    return read(spark, sf_dir, "documents").select("doc_id", F.array_join(T.tagged(F.col("text"), {"idiot": "insult", "clown": "insult", "password": "secret"}), ",").alias("tags"))


@query(r"SELECT page_id, CAST(len(regexp_extract_all(html, 'https?://[^\s<>\"'')\]]+')) AS INTEGER) AS n_urls, len(list_filter(regexp_extract_all(html, 'https?://[^\s<>\"'')\]]+'), lambda u: regexp_matches(u, '(?i)youtube\.com/watch\?v=|youtu\.be/|vimeo\.com/\d'))) > 0 AS has_video FROM pages")
def q_page_urls(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.size(T.urls(F.col("html"))).alias("n_urls"), F.exists(T.urls(F.col("html")), T.is_video).alias("has_video"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, TRY_CAST(CASE WHEN o_orderkey % 10 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) IS NOT NULL AS valid FROM orders")
def q_timestamps(spark, sf_dir):
    raw = F.when(F.col("o_orderkey") % 10 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return read(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.try_to_timestamp(raw).isNotNull().alias("valid"))


@query("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents), h AS (SELECT *, ends_with(trim(line), '.') AND length(line) < 40 AS opens FROM l),
s AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS section FROM h)
SELECT doc_id, CAST(section AS BIGINT) AS section, count(*) AS lines FROM s GROUP BY ALL
""")
def q_line_islands(spark, sf_dir):
    """Sections of documents: a short line with a full stop opens one."""
    rows = rollup.lines(read(spark, sf_dir, "documents"))
    marked = rollup.islands(rows, ["doc_id"], "line_no", F.endswith(F.trim("line"), F.lit(".")) & (F.length("line") < 40))
    return marked.groupBy("doc_id", "section").agg(F.count("*").alias("lines"))


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS r FROM documents) WHERE r <= 3")
def q_sample_per_group(spark, sf_dir):
    """Three documents of each language, by a hash of the id."""
    return rollup.top_n(read(spark, sf_dir, "documents").select("doc_id", "lang"), ["lang"], [F.md5(F.col("doc_id").cast("string")), F.col("doc_id")], 3).select("doc_id")


@query("SELECT doc_id, round((CASE WHEN lang = 'en' THEN 1 ELSE 0 END + CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END) / 2, 6) AS share FROM documents")
def q_row_completeness(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang") == "en", 1).alias("a"), F.when(F.col("n_chars") > 1000, 1).alias("b"))
    return d.select("doc_id", F.round(completeness(d, ["a", "b"]), 6).alias("share"))


@query("SELECT page_id, CASE WHEN regexp_matches(url, '/en/') THEN 'text_en' WHEN page_id % 2 = 0 THEN 'even' ELSE 'odd' END AS label FROM pages")
def q_first_non_empty(spark, sf_dir):
    """The first source that has a value."""
    p = read(spark, sf_dir, "pages")
    group = R.group_of(F.col("url"), PAGE_RULES)
    sources = [F.when(group == 1, "text_en").otherwise(""), F.when(F.col("page_id") % 2 == 0, "even").otherwise(" "), F.lit("odd")]
    from ..sources.files import first_known

    return p.select("page_id", first_known(sources).alias("label"))


@query()
def q_fuzzy_docs(spark, sf_dir):
    """Best match of every labelled document's first 200 characters among the unlabelled documents of its language."""
    d = read(spark, sf_dir, "documents").select("doc_id", F.lit("text").alias("atom_type"), F.col("lang").alias("term"), T.norm_start(F.col("text"), 200).alias("norm"))
    return fuzzy_sides(checkpointed(d), read(spark, sf_dir, "labels").select("doc_id"))


def fuzzy_sides(d, labelled):
    """match_fuzzy of the labelled rows of d with the others. Equal rows of a side are matched once, and equal ones across the sides without a search."""
    lab = labelled.distinct()
    same = ["norm", "atom_type", "term"]
    source, target = (d.join(lab, "doc_id", how).groupBy(*same).agg(F.min("doc_id").alias("atom_id")).withColumn("ord", F.col("atom_id")) for how in ("left_semi", "left_anti"))
    equal = source.join(target.select(*same, F.col("atom_id").alias("target_id")), same).where(F.length("norm") >= 5)  # equal texts have ratio 1, by the block that begins both
    equal = equal.select("atom_id", "target_id", F.lit("fuzzy").alias("tier"), F.lit(1.0).alias("confidence"))
    found = equal.union(match_fuzzy(source.join(equal, "atom_id", "left_anti"), target).select(*equal.columns))
    of = source.select(*same, F.col("atom_id").alias("least"))
    members = d.join(lab, "doc_id", "left_semi").join(of, same).select(F.col("doc_id").alias("atom_id"), "least")
    return members.join(found.withColumnRenamed("atom_id", "least"), "least").select("atom_id", "target_id", "tier", "confidence")


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL")
def q_stream_counts(spark, sf_dir):
    """Running counts by Structured Streaming over the events file, as they stand at the end."""
    out = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = read(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    keep = lambda batch, _: batch.write.mode("overwrite").parquet(f"{out}/rows")
    feeds.running_counts(stream, "user_id", "event_type").writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def activity_responses(spark, sf_dir):
    """Events as activity responses: every third has a time of its own, the others a range with or without an end; the detail is the event's properties under its type."""
    e = read(spark, sf_dir, "events")
    name, at, quoted = F.col("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), lambda *c: F.concat(F.lit('"'), *c, F.lit('"'))
    span = F.concat(F.lit('"timeRange":{"startTime":'), quoted(at), F.when(name % 3 == 1, F.concat(F.lit(',"endTime":'), quoted(F.lit("end "), at))).otherwise(""), F.lit("}"))
    when = F.when(name % 3 == 0, F.concat(F.lit('"timestamp":'), quoted(at))).otherwise(span)
    detail = F.concat(F.lit('{"'), F.col("event_type"), F.lit('":'), F.col("props"), F.lit("}"))
    who = F.concat(F.lit('[{"user":{"knownUser":{"personName":'), quoted(F.col("user_id").cast("string")), F.lit("}}}]"))
    item = F.concat(F.lit('[{"driveItem":{"name":'), quoted(F.lit("items/"), name.cast("string")), F.lit("}}]"))
    return e.select("event_id", F.concat(F.lit('{"activities":[{'), when, F.lit(',"actors":'), who, F.lit(',"actions":[{"detail":'), detail, F.lit('}],"targets":'), item, F.lit("}]}")).alias("response"))


@query("""
SELECT event_id, CASE event_id % 3 WHEN 1 THEN 'end ' ELSE '' END || strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, CAST(user_id AS VARCHAR) AS person, event_type AS action, CAST(props->>'k' AS BIGINT) AS k, CAST(event_id AS VARCHAR) AS file_id FROM events
""")
def q_activities_parsed(spark, sf_dir):
    """Activity responses read to typed rows; a free-form detail is looked into by path."""
    a = feeds.parsed_activities(activity_responses(spark, sf_dir))
    one = F.col("actions")[0]
    return a.select("event_id", F.col("timestamp").alias("at"), F.col("actors")[0]["person_name"].alias("person"), one["type"].alias("action"), F.try_variant_get(one["detail"], "$.k", "long").alias("k"), F.col("targets")[0]["file_id"].alias("file_id"))


@query("SELECT event_type AS type, count(*) AS n, 'OBJECT<k: BIGINT>' AS schema FROM events GROUP BY event_type")
def q_detail_schemas(spark, sf_dir):
    """The schema that the details of each type of action have together."""
    return feeds.detail_schemas(feeds.parsed_activities(activity_responses(spark, sf_dir)))


@query("SELECT user_id, 'NEW' AS change_type, arg_max(props, ts) AS props, CAST(NULL AS VARCHAR) AS previous_props, CAST(NULL AS VARCHAR) AS previous_event_type FROM events GROUP BY user_id")
def q_stream_changes(spark, sf_dir):
    """Changes of keys against the state store, over a stream of one batch: every key is new, with the row last modified."""
    out, events = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}", read(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    feeds.start_diffs(stream, f"{out}/changes", f"{out}/state", key="user_id", content="event_type", name="props", modified="ts").awaitTermination()
    return spark.read.parquet(f"{out}/changes").drop("batch")
