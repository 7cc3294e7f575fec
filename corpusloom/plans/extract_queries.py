"""Queries of the extraction rules and lookups over documents, pages, parts, events and conversations; each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import extract, rollup, tallies
from .check_queries import REC, page_records, q_boundary_checks, q_group_checks
from .queries import ORACLE, query, read

_LINES = "l AS (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL)"


def parts(spark, sf_dir):
    """Documents as decks of one slide: the text is the body, its last line the notes."""
    d = read(spark, sf_dir, "documents").where("text is not null")
    return d.select("doc_id", F.lit(1).alias("slide"), F.col("text").alias("body"), F.element_at(F.split("text", "\n"), -1).alias("notes"))


@query(f"""
WITH {_LINES}, n AS (SELECT doc_id, string_split(text, chr(10))[-1] AS notes FROM documents WHERE text IS NOT NULL)
SELECT l.doc_id, 0 AS priority, CAST(i AS INTEGER) AS line_no, line FROM l JOIN documents d USING (doc_id, ) WHERE regexp_matches(lower(d.text), 'the |und ') AND length(line) > 25 AND NOT regexp_matches(lower(line), 'lorem|click') AND d.text IS NOT NULL
UNION ALL SELECT doc_id, 1, 0, trim(notes) FROM n WHERE regexp_matches(lower(notes), 'the |und ') AND length(trim(notes)) > 40 AND regexp_matches(lower(trim(notes)), 'the |und ')
""".replace("(doc_id, )", "(doc_id)"))
def q_activities(spark, sf_dir):
    """Lines of texts that name a trigger word, then of their notes."""
    return extract.activities(parts(spark, sf_dir), "the |und ", "lorem|click", "the |und ").drop("slide")


@query(f"""
WITH {_LINES}, t AS (SELECT DISTINCT doc_id, line AS topic FROM l WHERE length(line) BETWEEN 8 AND 70 AND len(string_split_regex(line, ' +')) BETWEEN 2 AND 8 AND regexp_matches(line, '^\\p{{Lu}}') AND NOT regexp_matches(line, '[.,?]$') AND NOT contains(line, ':') AND NOT regexp_matches(lower(line), '^the '))
SELECT * FROM t UNION ALL SELECT d.doc_id, upper(substring(w.w, 1, 1)) || substring(w.w, 2) FROM documents d, (VALUES ('copyright'), ('password'), ('idiot')) w(w)
WHERE d.text IS NOT NULL AND contains(lower(d.text), w.w) AND NOT EXISTS (SELECT 1 FROM t WHERE t.doc_id = d.doc_id AND contains(lower(topic), w.w))
""")
def q_topic_lines(spark, sf_dir):
    """Heading-like lines and words of a dictionary that no such line holds."""
    words = spark.createDataFrame([("copyright",), ("password",), ("idiot",)], "key_word string")
    return extract.topic_lines(parts(spark, sf_dir), "^the ", words)


@query("SELECT doc_id, CAST(len(list_distinct(list_transform(regexp_extract_all(text, '(?i)idiot[^\\n.]*|password[^\\n.]*'), lambda x: x))) > 0 AS BOOLEAN) AS any, len(regexp_extract_all(text, '(?i)token\\s*=\\s*([^\\n ]+)', 1)) > 0 OR len(regexp_extract_all(text, '(?i)idiot[^\\n.]*|password[^\\n.]*')) > 0 AS found FROM documents WHERE text IS NOT NULL")
def q_artifacts(spark, sf_dir):
    """Whether titled or bare marks occur."""
    t = F.col("text")
    bare = extract.artifacts(t, "a^", "(?i)idiot[^\\n.]*|password[^\\n.]*", "Token: ")
    both = extract.artifacts(t, "(?i)token\\s*=\\s*([^\\n ]+)", "(?i)idiot[^\\n.]*|password[^\\n.]*", "Token: ")
    return read(spark, sf_dir, "documents").where("text is not null").select("doc_id", (F.size(bare) > 0).alias("any"), (F.size(both) > 0).alias("found"))


@query("""
WITH s AS (SELECT doc_id, list_concat(list_transform(regexp_extract_all(text, '(?i)the\\s*[:–\\-]\\s*([^\\n]+)', 1), lambda m: 'the: ' || trim(m)), list_transform(regexp_extract_all(text, '[A-Z]{2}-[0-9]+'), lambda x: trim(x)), list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: regexp_matches(lower(x), '^(die|les) '))) AS s FROM documents WHERE text IS NOT NULL)
SELECT doc_id, len(list_distinct(list_filter(s, lambda x: x <> ''))) AS n FROM s
""")
def q_signals(spark, sf_dir):
    """Levels, codes and statements of a text, each once."""
    s = extract.signals(F.col("text"), ["the"], "[A-Z]{2}-[0-9]+", "^(die|les) ")
    return read(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.size(s).cast("long").alias("n"))


@query(f"""
WITH {_LINES}, a AS (SELECT *, min(CASE WHEN regexp_matches(lower(line), '(^| )(the|die|les|para)( |$)') THEN i END) OVER (PARTITION BY doc_id) AS hd FROM l),
k AS (SELECT doc_id, i, hd, regexp_replace(line, '^[\\d.)\\-•*]+ *', '') AS line FROM a WHERE hd IS NOT NULL AND i <> hd), f AS (SELECT *, CASE WHEN i > hd THEN 'after' ELSE 'before' END AS side FROM k WHERE length(line) >= 10 AND NOT regexp_matches(lower(line), 'http')),
m AS (SELECT *, length(line) < 60 AND regexp_matches(line, '^\\p{{Lu}}') AND NOT ends_with(line, '.') AND side = 'after' AS title FROM f),
h AS (SELECT *, coalesce(lag(title) OVER w AND lag(side) OVER w = 'after', false) AS held, lag(line) OVER w AS prev, title AND coalesce(NOT lead(title) OVER w AND lead(side) OVER w = 'after', false) AS used FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, side, i, CASE WHEN held AND NOT title THEN prev || ': ' || line ELSE line END AS t FROM h WHERE NOT used),
c AS (SELECT doc_id, count(*) FILTER (side = 'after') AS na, count(*) FILTER (side = 'before') AS nb FROM g GROUP BY 1)
SELECT g.doc_id, side, count(*) AS n, sha256(string_agg(t, '|' ORDER BY i)) AS items FROM g JOIN c USING (doc_id) WHERE side = CASE WHEN na >= nb THEN 'after' ELSE 'before' END GROUP BY g.doc_id, side
""")
def q_objectives(spark, sf_dir):
    """Lines around a heading, from the side that has more."""
    o = extract.objectives(parts(spark, sf_dir), r"(^| )(the|die|les|para)( |$)", "http")
    return o.select("doc_id", "side", F.size("objectives").cast("long").alias("n"), F.sha2(F.array_join("objectives", "|"), 256).alias("items"))


@query(f"""
WITH {_LINES}, h AS (SELECT *, regexp_matches(line, '^[^ ]+ [^ ]+\\.$') AS opens FROM l), s AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS section FROM h),
b AS (SELECT doc_id, section, coalesce(max(CASE WHEN opens THEN line END), '_preamble') AS heading, trim(coalesce(string_agg(CASE WHEN NOT opens THEN line END, chr(10) ORDER BY i), '')) AS body FROM s GROUP BY 1, 2),
k AS (SELECT doc_id, heading, arg_max(body, section) AS body FROM b GROUP BY 1, 2),
f AS (SELECT doc_id, unnest(CASE WHEN heading = '_preamble' OR NOT regexp_matches(lower(heading), 'the|un') THEN ['remaining'] ELSE list_filter([CASE WHEN regexp_matches(lower(heading), 'the') THEN 'one' END, CASE WHEN regexp_matches(lower(heading), 'un') THEN 'two' END], lambda x: x IS NOT NULL) END) AS field, heading, body FROM k WHERE trim(body) <> '')
SELECT doc_id, field, sha256(string_agg(body, ' ' ORDER BY heading)) AS value FROM f GROUP BY 1, 2
""")
def q_section_fields(spark, sf_dir):
    """Section bodies by the field of their heading, and what no field takes."""
    rows = rollup.lines(read(spark, sf_dir, "documents").where("text is not null")).withColumn("line", F.trim("line"))
    marked = rollup.islands(rows, ["doc_id"], "line_no", F.col("line").rlike(r"^[^ ]+ [^ ]+\.$")).withColumn("opens", F.col("line").rlike(r"^[^ ]+ [^ ]+\.$"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("opens"), F.struct("line_no", "line")))), lambda x: x["line"]), "\n")
    g = marked.groupBy("doc_id", "section").agg(F.coalesce(F.max(F.when(F.col("opens"), F.col("line"))), F.lit("_preamble")).alias("heading"), F.trim(body).alias("body"))
    s = g.groupBy("doc_id", "heading").agg(F.max_by("body", "section").alias("body"))
    return extract.section_fields(s, {"one": "the", "two": "un"}).withColumn("value", F.sha2("value", 256))


@query(r"SELECT doc_id, nullif(trim(regexp_extract(text, 'password:\s*([^\n]+)', 1)), '') AS secret, nullif(trim(regexp_extract(text, 'Copyright\s*([^\n]+)', 1)), '') AS owner FROM documents WHERE text IS NOT NULL")
def q_label_values(spark, sf_dir):
    """Values after labels, up to the end of the line."""
    one = extract.label_values(F.col("text"), {"secret": "password"})
    return read(spark, sf_dir, "documents").where("text is not null").select("doc_id", *one, F.nullif(F.trim(F.regexp_extract("text", r"Copyright\s*([^\n]+)", 1)), F.lit("")).alias("owner"))


@query(r"SELECT page_id, len(list_distinct(list_transform(list_filter(string_split(replace(html, '<p>', chr(10)), chr(10)), lambda x: regexp_matches(x, '(Et|The|Die)')), lambda x: regexp_extract(x, '(Et|The|Die)', 1) || trim(regexp_extract(x, '(Et|The|Die).*', 0))))) AS n FROM pages")
def q_alignments(spark, sf_dir):
    """Lines from a framework name on, with the name."""
    p = read(spark, sf_dir, "pages").select("page_id", F.replace("html", F.lit("<p>"), F.lit("\n")).alias("t"))
    return p.select("page_id", F.size(extract.alignments(F.col("t"), ["Et", "The", "Die"])).cast("long").alias("n"))


@query(r"""
WITH p AS (SELECT page_id, replace(html, '<p>', chr(10)) AS t FROM pages), a AS (SELECT page_id, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x)), lambda x: length(x) >= 40 AND NOT regexp_matches(x, '^[|#]')) AS ls FROM p)
SELECT page_id, substring(coalesce(ls[1], ''), 1, 500) AS purpose FROM a
""")
def q_purpose(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", extract.purpose(F.replace("html", F.lit("<p>"), F.lit("\n"))).alias("purpose"))


@query(r"""
WITH p AS (SELECT page_id, replace(html, '<p>', chr(10) || '- ') AS t FROM pages), i AS (SELECT page_id, list_filter(list_transform(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '^ *[-•*]')), lambda x: trim(regexp_replace(x, '^ *[-•*]+', ''))), lambda x: length(x) >= 10) AS it FROM p)
SELECT page_id, len(list_slice(list_filter(it, lambda x: regexp_matches(lower(x), 'the|und|que')), 1, 10)) AS skills, len(list_slice(list_filter(it, lambda x: NOT regexp_matches(lower(x), 'the|und|que') AND regexp_matches(lower(x), 'ing|en')), 1, 10)) AS criteria FROM i
""")
def q_skills(spark, sf_dir):
    """Bullets that name a skill, and criteria among the others."""
    cols = extract.skills_and_criteria(F.replace("html", F.lit("<p>"), F.lit("\n- ")), "the|und|que", "ing|en")
    return read(spark, sf_dir, "pages").select("page_id", *cols).select("page_id", F.size("skills").cast("long").alias("skills"), F.size("criteria").cast("long").alias("criteria"))


@query("SELECT conv_id, sha256(string_agg(CASE WHEN role = 'user' THEN role || ' | ' || text ELSE text END, chr(10) ORDER BY turn)) AS text FROM conversations WHERE text IS NOT NULL GROUP BY conv_id")
def q_flattened(spark, sf_dir):
    """Turns as blocks, users' as table rows, flattened to one text."""
    c = read(spark, sf_dir, "conversations").where("text is not null")
    block = F.struct("turn", F.when(F.col("role") == "user", "table").otherwise("paragraph").alias("kind"), "text", F.array(F.array("role", "text")).alias("rows"))
    return c.groupBy("conv_id").agg(F.array_sort(F.collect_list(block)).alias("b")).select("conv_id", F.sha2(extract.flattened_text(F.col("b")), 256).alias("text"))


@query("WITH m AS (SELECT DISTINCT regexp_extract(lower(url), '://([^/]+)', 1) AS stem FROM pages) SELECT page_id AS item, min(stem) AS stem FROM pages JOIN m ON contains(lower(url), stem) WHERE stem <> '' GROUP BY page_id")
def q_contained_key(spark, sf_dir):
    """The first manifest stem inside a path."""
    p = read(spark, sf_dir, "pages")
    stem = p.select(F.regexp_extract(F.lower("url"), "://([^/]+)", 1).alias("stem")).where("stem <> ''").distinct()
    return extract.contained_key(p.select(F.col("page_id").alias("item"), F.col("url").alias("path")), stem.select("stem", F.col("stem").alias("ord")))


@query("WITH w AS (SELECT unnest(range(1, 7)) AS week), k AS (SELECT CAST(week AS INTEGER) AS week, unnest([2 * week - 1, 2 * week]) AS size FROM w) SELECT p_partkey, p_size, week FROM part LEFT JOIN k ON p_size = k.size")
def q_week_of_key(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", "p_size")
    return extract.key_of_range(p, "p_size", {w: [2 * w - 1, 2 * w] for w in range(1, 7)}).select("p_partkey", "p_size", "week")


@query("SELECT batch, key FROM (SELECT DISTINCT p_brand AS batch, unnest(CASE WHEN p_brand = 'Brand#11' THEN [1, 2, 3] WHEN regexp_matches(p_brand, '#([0-9]+)') THEN [CAST(regexp_extract(p_brand, '#([0-9]+)', 1) AS INTEGER)] ELSE [] END) AS key FROM part)")
def q_batch_keys(spark, sf_dir):
    """Keys from a batch's name, or of a named batch."""
    return extract.batch_keys(read(spark, sf_dir, "part").select(F.col("p_brand").alias("batch")).distinct(), "#([0-9]+)", {"Brand#11": [1, 2, 3]})


@query("SELECT key, count(*) AS n, sha256(string_agg(text, '|' ORDER BY item_id)) AS items FROM benchmark JOIN (SELECT item_id, unnest([item_id % 5, 5 + item_id % 3]) AS key FROM benchmark) USING (item_id) GROUP BY key")
def q_texts_per_key(spark, sf_dir):
    b = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("item"), "text")
    keys = b.select("item", F.explode(F.array(F.col("item") % 5, 5 + F.col("item") % 3)).alias("key"))
    out = extract.texts_per_key(b, keys)
    return out.select("key", F.size("items").cast("long").alias("n"), F.sha2(F.array_join(F.transform("items", lambda x: x["text"]), "|"), 256).alias("items"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 AND regexp_matches(p_name, '^[a-m]') THEN p_name WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END AS a, CASE WHEN p_partkey % 3 = 0 AND regexp_matches(p_name, '^[a-m]') THEN '' ELSE p_name END AS b FROM part")
def q_repair_shift(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_brand")).alias("a"), F.col("p_name").alias("b"))
    return extract.repair_shift(p, "a", "b", "^[a-m]")


@query("""
WITH n AS (SELECT DISTINCT p_name AS name, regexp_replace(lower(p_name), '[ _-]', '', 'g') AS s FROM part), f AS (SELECT p_partkey AS ord, p_name || '.' || p_brand AS file, regexp_replace(lower(regexp_replace(p_name || '.' || p_brand, '\\.\\w+$', '')), '[ _-]', '', 'g') AS s FROM part WHERE p_partkey % 2 = 0)
SELECT name, arg_min(file, ord) AS file FROM n JOIN f ON contains(f.s, substring(n.s, 1, 20)) OR contains(n.s, substring(f.s, 1, 20)) WHERE n.s <> '' AND f.s <> '' GROUP BY name
""")
def q_prefix_match(spark, sf_dir):
    """The first file whose squeezed name begins inside a template's, or the other way round."""
    p = read(spark, sf_dir, "part")
    files = p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("ord"), F.concat_ws(".", "p_name", "p_brand").alias("file"))
    return extract.prefix_match(p.select(F.col("p_name").alias("name")).distinct(), files)


@query("WITH r AS (SELECT o_orderkey AS ord, unnest([o_custkey, o_orderkey]) AS id FROM orders) SELECT c_custkey AS id, min(r.ord) AS ord FROM customer LEFT JOIN r ON r.id = c_custkey GROUP BY c_custkey")
def q_either_id(spark, sf_dir):
    """Customers with the first order that has their number as customer or as order."""
    rows = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ord"), "o_custkey", "o_orderkey")
    return extract.by_either_id(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), rows, "o_custkey", "o_orderkey")


@query("SELECT conv_id, turn, 'b' AS src FROM conversations WHERE role = 'user' UNION ALL SELECT conv_id, min(turn), 'n' FROM conversations c WHERE NOT EXISTS (SELECT 1 FROM conversations d WHERE d.role = 'user' AND d.conv_id = c.conv_id AND d.turn = c.turn) GROUP BY conv_id, turn")
def q_filled_in(spark, sf_dir):
    """Users' turns, and of all turns those that are still missing."""
    c = read(spark, sf_dir, "conversations")
    base = c.where("role = 'user'").select("conv_id", "turn", F.lit("b").alias("src"))
    return extract.filled_in(base, c.select("conv_id", "turn", F.lit("n").alias("src")), ["conv_id", "turn"], "src")


@query("SELECT DISTINCT event_id, json_extract_string(props, '$.' || k) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events WHERE json_valid(props)) WHERE trim(json_extract_string(props, '$.' || k)) <> ''")
def q_json_strings(spark, sf_dir):
    """Distinct values of the events' properties."""
    return extract.strings_of(read(spark, sf_dir, "events"), "props", "event_id")


@query("SELECT p_brand AS source, sha256(string_agg(p_name, '|' ORDER BY p_size, p_name)) AS results FROM part WHERE p_size % 4 <> 0 GROUP BY p_brand")
def q_compiled_batches(spark, sf_dir):
    r = read(spark, sf_dir, "part").where("p_size % 4 <> 0").select(F.col("p_size").alias("batch"), F.col("p_brand").alias("source"), F.col("p_name").alias("value"))
    by_source, _ = extract.compiled_batches(r, r.select("batch").distinct())
    return by_source.select("source", F.sha2(F.array_join("values", "|"), 256).alias("results"))


@query("SELECT p_size AS batch, CASE WHEN p_size % 4 <> 0 THEN 'completed' ELSE 'pending' END AS status, count(*) FILTER (p_size % 4 <> 0) AS results FROM part GROUP BY p_size")
def q_batch_ledger(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    r = p.where("p_size % 4 <> 0").select(F.col("p_size").alias("batch"), F.col("p_brand").alias("source"), F.col("p_name").alias("value"))
    return extract.compiled_batches(r, p.select(F.col("p_size").alias("batch")).distinct())[1]


@query("WITH a AS (SELECT 0 AS source_no, page_id AS ord, url FROM pages UNION ALL SELECT 1, page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) FROM pages) SELECT url, arg_min(source_no, source_no * 1000000000 + ord) AS source_no, arg_min(ord, source_no * 1000000000 + ord) AS ord FROM a GROUP BY url")
def q_united_links(spark, sf_dir):
    """All urls of pages and their links, each once: the first by source and page."""
    p = read(spark, sf_dir, "pages")
    hrefs = p.select(F.col("page_id").alias("ord"), F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("url"), F.lit("link").alias("kind"))
    return extract.united_links(p.select(F.col("page_id").alias("ord"), "url"), hrefs).select("url", "source_no", "ord")


@query("SELECT page_id, len(list_distinct(list_filter(list_transform(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1), lambda x: lower(x)), lambda x: x <> ''))) >= 1 AS some, true AS kept FROM pages")
def q_merged_resources(spark, sf_dir):
    """Two lists of links merged: none of the kept ones is inside one before it."""
    p = read(spark, sf_dir, "pages").select("page_id", F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)).alias("a"), F.array("url").alias("b"))
    m = p.select("page_id", extract.merged_resources(F.col("a"), F.col("b")).alias("m"))
    ok = F.forall(F.transform("m", lambda x, i: F.struct(x.alias("x"), F.slice("m", 1, i).alias("before"))), lambda s: ~F.exists(s["before"], lambda y: F.contains(F.lower(y), F.lower(s["x"]))))
    return m.select("page_id", (F.size("m") >= 1).alias("some"), ok.alias("kept"))


@query("SELECT source, lang, count(*) AS n, sha256(substring(coalesce(string_agg(text, chr(10) ORDER BY doc_id), ''), 1, 5000)) AS evidence FROM documents WHERE text IS NOT NULL GROUP BY ALL")
def q_evidence(spark, sf_dir):
    """The evidence pack of every key: its texts in order, cut at the pack's size."""
    d = read(spark, sf_dir, "documents").where("text is not null")
    out = extract.evidence(d, d.select("source", "lang", F.col("doc_id").alias("ord"), "text"), ["source", "lang"], 5000)
    return out.select("source", "lang", F.col("n").cast("long").alias("n"), F.sha2("evidence", 256).alias("evidence"))


@query(f"WITH {REC} SELECT page_id, title, term, CAST(NULL AS VARCHAR) AS tools FROM rec")
def q_field_lookup(spark, sf_dir):
    """Fields of records by dotted paths, one of which isn't there."""
    rec = page_records(spark, sf_dir).select("page_id", F.struct("title", "term").alias("metadata"))
    return rec.select("page_id", extract.field(rec, "metadata.title").alias("title"), extract.field(rec, "metadata.term").alias("term"), extract.field(rec, "metadata.tools").alias("tools"))


@query(f"""
WITH x AS (SELECT check_id, failures, total, passed FROM ({ORACLE["q_group_checks"]}) UNION ALL SELECT check_id, failures, total, passed FROM ({ORACLE["q_boundary_checks"]}))
SELECT check_id, passed, CASE WHEN total > 0 THEN round(100 * failures / total, 1) ELSE 0.0 END AS percent, CASE WHEN passed THEN check_id || ' passed on ' || total || ' rows' ELSE check_id || ' failed on ' || failures || ' of ' || total || ' rows' END AS text FROM x
""")
def q_explained_checks(spark, sf_dir):
    """A sentence for every check of groups and boundaries."""
    return extract.explained(q_group_checks(spark, sf_dir).union(q_boundary_checks(spark, sf_dir)))


@query("SELECT p_name, count(*) AS copies FROM (SELECT p_name, p_partkey, min(p_partkey) OVER (PARTITION BY p_name) AS f FROM part) WHERE p_partkey <> f AND p_name IN (SELECT p_name FROM part WHERE p_brand = 'Brand#11') GROUP BY p_name")
def q_group_duplicates(spark, sf_dir):
    """Later copies whose name occurs in one group."""
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_name", "p_brand")
    inside = p.where("p_brand = 'Brand#11'").select("p_name").distinct()
    return tallies.duplicates_in_group(p, "p_name", "id", inside)


@query("SELECT e.doc_id, e.toxic, s.source, s.docs FROM labels e LEFT JOIN documents d USING (doc_id) LEFT JOIN (SELECT source, count(*) AS docs FROM documents GROUP BY source) s ON s.source = d.source WHERE e.toxic = 1")
def q_errors_with_source(spark, sf_dir):
    """Errors with the source rows of their key."""
    d = read(spark, sf_dir, "documents")
    e = read(spark, sf_dir, "labels").where("toxic = 1").join(d.select("doc_id", "source"), "doc_id", "left")
    return tallies.with_source_rows(e, d, "source", F.count("*").alias("docs")).select("doc_id", "toxic", "source", "docs")


@query("SELECT p.page_id, min(q.page_id) AS source_id FROM pages p JOIN pages q ON regexp_extract(p.url, '/([0-9]+)', 1) = regexp_extract(q.url, '/([0-9]+)', 1) AND starts_with(q.url, 'https') WHERE regexp_extract(p.url, '/([0-9]+)', 1) <> '' GROUP BY p.page_id")
def q_source_of_record(spark, sf_dir):
    """A record's source document, by stem, where one exists."""
    p = read(spark, sf_dir, "pages").select("page_id", "url", F.regexp_extract("url", "/([0-9]+)", 1).alias("stem"))
    return tallies.source_of_record(p, p.where("url like 'https%'"), "stem", "page_id", "page_id")


@query(r"SELECT lang, count(*) AS texts, count(*) FILTER (len(regexp_extract_all(text, '\d+')) > 0) AS with_numbers, count(*) FILTER (len(regexp_extract_all(text, '\d+')) = 0) AS without FROM documents WHERE text IS NOT NULL GROUP BY lang")
def q_extraction_totals(spark, sf_dir):
    """Totals with and without a mapping."""
    n = F.size(F.regexp_extract_all("text", F.lit(r"\d+"), F.lit(0)))
    return tallies.mapped_totals(read(spark, sf_dir, "documents").where("text is not null"), "lang", n > 0)


@query("SELECT 'quality' AS annotator, CAST(quality AS VARCHAR) AS kind, count(*) AS n FROM labels GROUP BY 2 UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR), count(*) FROM labels GROUP BY 2")
def q_annotator_volume(spark, sf_dir):
    """Volumes of two annotators by kind."""
    return tallies.annotator_volumes(read(spark, sf_dir, "labels"), ["quality", "toxic"])


@query("SELECT lang, list_sort(list(doc_id))[1:5]::VARCHAR AS examples, count(*) AS n FROM documents WHERE n_chars < 200 GROUP BY lang")
def q_examples(spark, sf_dir):
    """The first five examples of each group, as text."""
    g = rollup.examples(read(spark, sf_dir, "documents").where("n_chars < 200"), ["lang"], "doc_id", 5)
    return g.select("lang", F.concat(F.lit("["), F.array_join(F.col("examples").cast("array<string>"), ", "), F.lit("]")).alias("examples"), "n")


@query("SELECT page_id, len(regexp_extract_all(html, '<p>')) AS slides, CASE WHEN contains(url, '/en/') THEN 1 ELSE 2 END AS term FROM pages")
def q_flat_records(spark, sf_dir):
    """Records as a flat list of term, id and number of parts."""
    return tallies.flat_records(read(spark, sf_dir, "pages"), "page_id", F.regexp_extract_all("html", F.lit("<p>"), F.lit(0)), F.when(F.contains("url", F.lit("/en/")), 1).otherwise(2))


@query("SELECT doc_id, similarity FROM (SELECT doc_id, round(len(list_intersect(list_distinct(string_split(lower(text), ' ')), list_distinct(string_split(lower(substring(text, 1, 300)), ' ')))) / len(list_distinct(string_split(lower(text), ' '))), 6) AS similarity FROM documents WHERE text IS NOT NULL AND length(text) > 0) WHERE similarity < 0.5")
def q_lowest_matches(spark, sf_dir):
    """Documents whose first 300 characters hold less than half of their words."""
    words = lambda x: F.array_distinct(F.split(F.lower(x), " "))
    d = read(spark, sf_dir, "documents").where("text is not null and length(text) > 0")
    return tallies.lowest_matches(d, F.size(F.array_intersect(words("text"), words(F.substring("text", 1, 300)))) / F.size(words("text")), 0.5, "doc_id")


@query("SELECT regexp_extract(lower(url), '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)', 1) AS host, count(*) AS n FROM pages GROUP BY 1")
def q_host_counts(spark, sf_dir):
    return read(spark, sf_dir, "pages").groupBy(T.host(F.col("url")).alias("host")).agg(F.count("*").alias("n"))




_NAMES = "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name || ' (' || p_partkey % 4 || ').PPTX' WHEN p_partkey % 3 = 1 THEN '  ' || upper(replace(p_name, ' ', '_')) || '.docx' ELSE substring(p_name, 1, 4) END AS n FROM part"


@query(f"""
WITH n AS ({_NAMES}) SELECT p_partkey, regexp_replace(lower(trim(regexp_replace(regexp_replace(n, '\\s*\\(\\d+\\)\\s*', '', 'g'), '[_\\-\\s]+', ' ', 'g'))), '\\.\\w+$', '') AS form,
  length(trim(regexp_replace(lower(n), '\\s+', ' ', 'g'))) < 5 AS trivial, (length(trim(regexp_replace(lower(n), '\\s+', ' ', 'g'))) <= 30 AND trim(regexp_replace(lower(n), '\\s+', ' ', 'g')) IN ('blue', 'red')) OR (length(trim(regexp_replace(lower(n), '\\s+', ' ', 'g'))) <= 60 AND regexp_matches(trim(regexp_replace(lower(n), '\\s+', ' ', 'g')), '^[a-c]')) AS label FROM n
""")
def q_name_forms(spark, sf_dir):
    """Normal forms of file names; trivial texts and structural labels."""
    k = F.col("p_partkey")
    n = F.when(k % 3 == 0, F.concat("p_name", F.lit(" ("), (k % 4).cast("string"), F.lit(").PPTX"))).when(k % 3 == 1, F.concat(F.lit("  "), F.upper(F.replace("p_name", F.lit(" "), F.lit("_"))), F.lit(".docx"))).otherwise(F.substring("p_name", 1, 4))
    return read(spark, sf_dir, "part").select("p_partkey", T.name_form(n).alias("form"), T.is_trivial(n).alias("trivial"), T.is_label(n, ["blue", "red"], "^[a-c]").alias("label"))


@query("""
WITH a AS (SELECT item_id AS k, string_split(substring(text, 1, 20), ' ') AS tags, substring(text, 1, 30) AS d FROM benchmark WHERE item_id % 2 = 0), b AS (SELECT item_id AS k, string_split(substring(text, 11, 20), ' ') AS tags, substring(text, 1, 10 + item_id % 40) AS d FROM benchmark WHERE item_id % 3 = 0)
SELECT coalesce(a.k, b.k) AS k, len(list_distinct(coalesce(a.tags, []) || coalesce(b.tags, []))) AS tags, CASE WHEN coalesce(length(b.d), 0) > coalesce(length(a.d), 0) THEN b.d ELSE a.d END AS description, CASE WHEN a.d IS NOT NULL AND b.d IS NOT NULL THEN 'high' ELSE 'single' END AS confidence FROM a FULL JOIN b ON a.k = b.k
""")
def q_merged_annotations(spark, sf_dir):
    """Two annotators merged: tags united, the longer description, who was there."""
    b, i = read(spark, sf_dir, "benchmark"), F.col("item_id")
    one = b.where(i % 2 == 0).select(i.alias("k"), F.split(F.substring("text", 1, 20), " ").alias("tags"), F.substring("text", 1, 30).alias("description"))
    two = b.where(i % 3 == 0).select(i.alias("k"), F.split(F.substring("text", 11, 20), " ").alias("tags"), F.col("text").substr(F.lit(1), (10 + i % 40).cast("int")).alias("description"))
    return rollup.merged_annotations(one, two, "k").select("k", F.size("tags").cast("long").alias("tags"), "description", "confidence")


@query("""
WITH v AS (SELECT * FROM (VALUES ('u1', 1, 5, NULL), ('u2', 2, 99, NULL), ('u3', NULL, NULL, 'the'), ('u4', NULL, NULL, 'no such words')) s(id, term, lesson, value)), r AS (SELECT CASE WHEN contains(url, '/en/') THEN 1 ELSE 2 END AS term, page_id % 20 AS lesson, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title FROM pages)
SELECT id, count(r.title) AS matches, count(r.title) > 0 AS passed FROM v LEFT JOIN r ON CASE WHEN v.value IS NULL THEN v.term = r.term AND v.lesson = r.lesson ELSE contains(lower(r.title), lower(v.value)) END GROUP BY id
""")
def q_lookups(spark, sf_dir):
    """Stored lookups by key and by value."""
    from ..operators.record_checks import lookups

    r = read(spark, sf_dir, "pages").select(F.when(F.contains("url", F.lit("/en/")), 1).otherwise(2).alias("term"), (F.col("page_id") % 20).alias("lesson"), F.trim(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))
    s = spark.createDataFrame([("u1", 1, 5, None), ("u2", 2, 99, None), ("u3", None, None, "the"), ("u4", None, None, "no such words")], "id string, term int, lesson int, value string")
    return lookups(r.select("term", "lesson", "title"), s)


@query("""
WITH s AS (SELECT page_id AS id, regexp_extract(url, '://([^/]+)', 1) AS stem, [page_id % 7, page_id % 5] AS sl, page_id % 3 AS term, page_id % 11 AS lesson FROM pages), t AS (SELECT page_id + 5000 AS id, regexp_extract(url, '://([^/]+)', 1) AS stem, [page_id % 7, page_id % 5 + (page_id % 2) * 3] AS sl, page_id % 3 AS term, page_id % 11 AS lesson FROM pages),
b AS (SELECT s.id, min(t.id) AS target_id FROM s JOIN t ON s.stem = t.stem AND list_sort(s.sl) = list_sort(t.sl) WHERE s.stem <> '' GROUP BY s.id), q AS (SELECT * FROM s WHERE id NOT IN (SELECT id FROM b)), c AS (SELECT q.id, min(t.id) AS target_id FROM q JOIN t ON q.term = t.term AND q.lesson = t.lesson AND list_has_any(q.sl, t.sl) GROUP BY q.id)
SELECT id AS atom_id, target_id, 'image' AS tier FROM b UNION ALL SELECT id, target_id, 'image_slides' FROM c
""")
def q_images(spark, sf_dir):
    """Images by stem and slides, then by a slide in common under one key."""
    from ..operators.reconcile import match_image

    p, i = read(spark, sf_dir, "pages"), F.col("page_id")
    of = lambda key, plus: p.select(key.alias("atom_id"), F.regexp_extract("url", "://([^/]+)", 1).alias("stem"), F.array(i % 7, i % 5 + plus).alias("slides"), (i % 3).alias("term"), (i % 11).alias("lesson"))
    return match_image(of(i, F.lit(0)), of(i + 5000, (i % 2) * 3)).select("atom_id", "target_id", "tier")


@query(r"SELECT page_id, len(regexp_extract_all(replace(html, '<p>', chr(10) || '- '), '(?m)^\s*(?:[-*•]|\d+[.)])\s+(.+)$', 1)) AS items, nullif(trim(regexp_replace(regexp_extract(replace(html, '<p>', chr(10)), '(?s)(?i)\bThe\s*[:\-]\s*(.+?)(?:\n\s*\n|$)', 1), '\s+', ' ', 'g')), '') IS NOT NULL AS labelled FROM pages")
def q_bullets(spark, sf_dir):
    """Items that begin with a bullet or a number; whether a label has a value."""
    from ..operators import records

    h = F.replace("html", F.lit("<p>"), F.lit("\n- "))
    return read(spark, sf_dir, "pages").select("page_id", F.size(records.bullets(h)).cast("long").alias("items"), records.labelled(F.replace("html", F.lit("<p>"), F.lit("\n")), "The").isNotNull().alias("labelled"))


@query("SELECT CASE event_type WHEN 'purchase' THEN 'MODIFIED' WHEN 'error' THEN 'DELETED' ELSE 'NEW' END AS change, count(*) AS n, count(DISTINCT user_id) AS keys, list_sort(list(event_type || '-' || event_id))[1:5]::VARCHAR AS examples FROM events GROUP BY 1")
def q_dry_run(spark, sf_dir):
    """What a run would do: changes by kind, the keys they touch, the first names."""
    e = read(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "purchase", "MODIFIED").when(F.col("event_type") == "error", "DELETED").otherwise("NEW")
    rows = e.select(kind.alias("change"), "user_id", F.concat_ws("-", "event_type", F.col("event_id").cast("string")).alias("name"))
    return tallies.run_summary(rows, "change", "user_id").withColumn("examples", F.concat(F.lit("["), F.array_join("examples", ", "), F.lit("]")))


@query("SELECT lang AS stage, count(*) AS n, list_sort(list(replace(substring(text, 1, 30), chr(10), ' ')))[1:3] AS examples FROM documents WHERE text IS NOT NULL AND n_chars < 400 GROUP BY lang")
def q_loss_examples(spark, sf_dir):
    """Short documents by language with the first texts, cut to 30 characters."""
    d = read(spark, sf_dir, "documents").where("text is not null and n_chars < 400").select(F.col("lang").alias("stage"), F.replace(F.substring("text", 1, 30), F.lit("\n"), F.lit(" ")).alias("text"))
    return tallies.loss_examples(d, "stage", "text", 3, 30)


_LINKED = r"""
h AS (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS u, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS t FROM pages),
r AS (SELECT page_id AS record, unnest(range(1, len(u) + 1)) AS ord, CASE unnest(range(1, len(u) + 1)) % 4 WHEN 0 THEN 'https://youtu.be/' || page_id WHEN 1 THEN url ELSE 'http://x.example' || unnest(u) END AS link, unnest(t) AS label FROM h)
"""


def page_links(spark, sf_dir):
    """The anchors of pages as links: a fourth lead to a video, a fourth to the page itself, the others to a path of a made host."""
    p = read(spark, sf_dir, "pages")
    anchor = '<a href="([^"]*)">([^<]*)</a>'
    both = F.arrays_zip(F.regexp_extract_all("html", F.lit(anchor), F.lit(1)).alias("u"), F.regexp_extract_all("html", F.lit(anchor), F.lit(2)).alias("t"))
    rows = p.select(F.col("page_id").alias("record"), F.col("url").alias("page"), F.posexplode(both).alias("place", "a"))
    n = F.col("place") + 1
    link = F.when(n % 4 == 0, F.concat(F.lit("https://youtu.be/"), F.col("record").cast("string"))).when(n % 4 == 1, F.col("page")).otherwise(F.concat(F.lit("http://x.example"), F.col("a.u")))
    return rows.select("record", n.cast("long").alias("ord"), link.alias("url"), F.col("a.t").alias("text"))


@query(f"""
WITH {_LINKED}, w AS (SELECT record, trim(link) AS link, trim(label) AS label, ord, row_number() OVER (PARTITION BY record, trim(link) ORDER BY ord) AS k FROM r WHERE NOT contains(link, 'youtu.be/') AND starts_with(trim(link), 'http'))
SELECT record, ord, CASE WHEN length(label) > 3 AND NOT starts_with(label, 'http') THEN label || ' - ' || link ELSE link END AS resource FROM w WHERE k = 1
""")
def q_resource_entries(spark, sf_dir):
    """Resource entries of pages from their links."""
    from ..operators.records import resource_entries

    return resource_entries(page_links(spark, sf_dir))


@query(rf"""
WITH {_LINKED}, v AS (SELECT record, ord, CASE WHEN ord % 4 = 0 THEN link ELSE '' END AS url, CASE WHEN ord % 4 = 2 THEN label || '.mp4' ELSE '' END AS filename, CASE WHEN ord % 4 = 0 THEN 'youtube' ELSE 'video_file' END AS type FROM r WHERE ord % 2 = 0),
d AS (SELECT *, row_number() OVER (PARTITION BY record, coalesce(nullif(url, ''), filename) ORDER BY ord) AS k FROM v)
SELECT record, CAST(row_number() OVER (PARTITION BY record ORDER BY ord) AS INTEGER) AS "order", CASE WHEN filename <> '' THEN regexp_replace(filename, '\.mp4$', '') ELSE '' END AS video_id, CASE type WHEN 'video_file' THEN filename ELSE url END AS title, CASE type WHEN 'video_file' THEN 'm/' || filename ELSE url END AS url, type FROM d WHERE k = 1
""")
def q_video_entries(spark, sf_dir):
    """Video entries of pages: links to videos and files named by an anchor, once each and numbered."""
    from ..operators.records import video_entries

    n, none = F.col("ord") % 4, F.lit("")
    rows = page_links(spark, sf_dir).where("ord % 2 = 0")
    name = F.when(n == 2, F.concat("text", F.lit(".mp4"))).otherwise(none)
    refs = rows.select("record", "ord", F.when(n == 0, F.col("url")).otherwise(none).alias("url"), name.alias("filename"), none.alias("video_id"), F.when(n == 0, "youtube").otherwise("video_file").alias("type"), none.alias("title"), F.concat(F.lit("m/"), name).alias("path"))
    return video_entries(refs)


_KINDS = {"schedule": ["the", "ing"], "rubric": ["tion", "de "], "other": ["que", "er"]}


@query("""
WITH b AS (SELECT item_id, lower(array_to_string(string_split(text, ' ')[1:4], ' ') || ' ' || array_to_string(string_split(text, ' ')[5:8], ' ')) AS t FROM benchmark),
h AS (SELECT item_id, contains(t, 'the')::INT + contains(t, 'ing')::INT AS a, contains(t, 'tion')::INT + contains(t, 'de ')::INT AS b, contains(t, 'que')::INT + contains(t, 'er')::INT AS c FROM b)
SELECT item_id, CASE WHEN a >= 2 THEN 'schedule' WHEN b >= 2 THEN 'rubric' WHEN c >= 2 THEN 'other' WHEN a = 1 THEN 'schedule' WHEN b = 1 THEN 'rubric' WHEN c = 1 THEN 'other' ELSE 'data' END AS kind FROM h
""")
def q_table_kinds(spark, sf_dir):
    """Kinds of tables made of benchmark words: four as headers, four as the first row, four that don't count."""
    from ..operators.records import table_kind

    w = F.split("text", " ")
    return read(spark, sf_dir, "benchmark").select("item_id", table_kind(F.slice(w, 1, 4), F.array(F.slice(w, 5, 4), F.slice(w, 9, 4)), _KINDS).alias("kind"))

