"""Queries of the engine's operators over the driver's tables, each with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as T
from ..operators import dedup, diff, reconcile, rollup, tallies
from ..operators.expect import Rule, completeness, expect, quality_cube, referenced, regression, unique, verdict
from ..session import saved
from ..sources.pages import page_links, page_paragraphs, parse_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


NORM = r"trim(regexp_replace(lower(text), '[\s\x0B\x1C-\x1F\x85\p{Z}]+', ' ', 'g'))"


def line_atoms(docs: DataFrame) -> DataFrame:
    """Line atoms of documents: one for each line of at least five normalised characters."""
    return rollup.lines(docs.where("text is not null")).select("doc_id", "line_no", T.norm(F.col("line")).alias("norm")).where(F.length("norm") >= 5)


@query(r"""
WITH l AS (SELECT lang, doc_id, trim(regexp_replace(lower(unnest(string_split(text, chr(10)))), '[\s\x0B\x1C-\x1F\x85\p{Z}]+', ' ', 'g')) AS norm FROM documents WHERE text IS NOT NULL),
a AS (SELECT * FROM l WHERE length(norm) >= 5),
t AS (SELECT DISTINCT sha256(norm) AS p FROM a WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT lang, count(*) AS atoms, count(t.p) AS matched, count(t.p) / count(*) AS coverage FROM a LEFT JOIN t ON sha256(a.norm) = t.p GROUP BY lang
""")
def q_coverage_by_lang(spark, sf_dir):
    """Share of line atoms that some labelled document holds too, by language."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    atoms = line_atoms(docs).select("doc_id", (F.col("doc_id") * 1000000 + F.col("line_no")).alias("atom_id"), F.sha2("norm", 256).alias("print"))
    of = lambda df: df.select("atom_id", F.lit("text_block").alias("atom_type"), F.lit(None).cast("string").alias("norm"), "print", F.lit(None).cast("int").alias("term"), F.lit(None).cast("int").alias("lesson"), F.col("atom_id").alias("ord"))
    found = reconcile.match_exact(of(atoms), of(atoms.join(labels.select("doc_id").distinct(), "doc_id", "left_semi")))
    each = atoms.join(docs.select("doc_id", "lang"), "doc_id").join(found.select("atom_id", "tier"), "atom_id", "left")
    out = reconcile.coverage(each.select("lang", F.when(F.col("tier").isNull(), "unmatched").otherwise("matched").alias("class")), "lang")
    return out.select("lang", "atoms", "matched", "coverage")


@query(f"""
WITH b AS (SELECT item_id, {NORM} AS n FROM benchmark), d AS (SELECT doc_id, {NORM} AS h FROM documents)
SELECT item_id, doc_id FROM b JOIN d ON contains(h, n)
""")
def q_contains_benchmark(spark, sf_dir):
    """Which documents hold a whole benchmark passage: the containment join."""
    needles = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("needle_id"), T.norm(F.col("text")).alias("norm"))
    hay = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("hay_id"), T.norm(F.col("text")).alias("norm"))
    return reconcile.contained(needles, hay).select(F.col("needle_id").alias("item_id"), F.col("hay_id").alias("doc_id"))


@query(f"""
WITH d AS (SELECT doc_id, sha256({NORM}) AS p FROM documents), f AS (SELECT p, min(doc_id) AS duplicate_of FROM d GROUP BY p)
SELECT 'md5_content' AS type, doc_id AS id, duplicate_of FROM d JOIN f USING (p) WHERE doc_id <> duplicate_of
""")
def q_exact_dup_docs(spark, sf_dir):
    docs = saved(spark)(read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), T.fingerprint(F.col("text")).alias("p")))  # texts are normalised once
    return dedup.later_copies(docs, "p", "id", "md5_content")


@query("SELECT p_name, min(p_partkey) AS p_partkey FROM part GROUP BY p_name")
def q_first_wins_part_name(spark, sf_dir):
    return dedup.first_wins(read(spark, sf_dir, "part").select("p_name", "p_partkey"), ["p_name"], ["p_partkey"])


@query("""
WITH n AS (SELECT DISTINCT p_name AS f FROM part)
SELECT a.f AS a, b.f AS b, 1 - levenshtein(a.f, b.f) / greatest(length(a.f), length(b.f)) AS ratio FROM n a JOIN n b ON a.f < b.f
WHERE 1 - levenshtein(a.f, b.f) / greatest(length(a.f), length(b.f)) >= 0.7
""")
def q_fuzzy_part_names(spark, sf_dir):
    """Pairs of part names with an edit ratio of 0.7 or more, without comparing all with all."""
    return dedup.similar_forms(read(spark, sf_dir, "part").select(F.col("p_name").alias("form")), 0.7)


@query()
def q_fuzzy_part_greedy(spark, sf_dir):
    """Greedy fuzzy duplicates of part names in the order of their first key."""
    parts = read(spark, sf_dir, "part").groupBy(F.col("p_name").alias("form")).agg(F.min("p_partkey").alias("ord"))
    return dedup.greedy_representatives(parts, dedup.similar_forms(parts, 0.7), saved(spark))


_PREV = "SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 11 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS md5, c_nationkey AS modified FROM customer WHERE c_custkey % 17 <> 0"
_CUR = "SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN c_name || ' new' ELSE c_name END AS name, c_acctbal AS md5, CASE WHEN c_custkey % 5 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS modified FROM customer WHERE c_custkey % 13 <> 0"
_DIFF = f"""
WITH p AS ({_PREV}), c AS ({_CUR}),
d AS (SELECT coalesce(c.id, p.id) AS id, c.name AS name, p.name AS previous_name, CASE WHEN p.id IS NULL THEN 'NEW' WHEN c.id IS NULL THEN 'DELETED' WHEN c.md5 <> p.md5 THEN 'MODIFIED'
  WHEN c.modified <> p.modified THEN 'METADATA_CHANGED' WHEN c.name <> p.name THEN 'RENAMED' ELSE 'UNCHANGED' END AS change_type FROM c FULL OUTER JOIN p ON c.id = p.id)
"""


def customer_diff(spark, sf_dir) -> DataFrame:
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("md5"), F.col("c_nationkey").alias("modified"))
    prev = c.where("id % 17 <> 0").withColumn("md5", F.when(F.col("id") % 11 == 0, F.col("md5") + 1).otherwise(F.col("md5")))
    cur = c.where("id % 13 <> 0").withColumns({"name": F.when(F.col("id") % 7 == 0, F.concat("name", F.lit(" new"))).otherwise(F.col("name")), "modified": F.when(F.col("id") % 5 == 0, F.col("modified") + 1).otherwise(F.col("modified"))})
    return diff.snapshot_diff(cur, prev, "id", "md5", "name", "modified")


@query(_DIFF + "SELECT id, change_type, name, previous_name FROM d")
def q_snapshot_diff(spark, sf_dir):
    return customer_diff(spark, sf_dir).select("id", "change_type", "name", "previous_name")


@query(_DIFF + "SELECT change_type, count(*) AS n FROM d GROUP BY change_type")
def q_change_counts(spark, sf_dir):
    return customer_diff(spark, sf_dir).groupBy("change_type").agg(F.count("*").alias("n"))


#: Which category of change makes which stages stale.
STAGE_PLAN = {"deleted": ["consolidate", "build", "check"], "metadata": ["consolidate"], "native": ["native", "consolidate", "build", "check"], "other": ["media", "convert", "consolidate", "build", "check"]}


@query(_DIFF + """, k AS (SELECT DISTINCT CASE change_type WHEN 'UNCHANGED' THEN 'none' WHEN 'DELETED' THEN 'deleted' WHEN 'RENAMED' THEN 'metadata' WHEN 'METADATA_CHANGED' THEN 'metadata'
  ELSE CASE WHEN id % 3 = 0 THEN 'native' ELSE 'other' END END AS category FROM d),
s AS (SELECT unnest(CASE category WHEN 'deleted' THEN ['consolidate', 'build', 'check'] WHEN 'metadata' THEN ['consolidate'] WHEN 'native' THEN ['native', 'consolidate', 'build', 'check']
  WHEN 'other' THEN ['media', 'convert', 'consolidate', 'build', 'check'] ELSE [] END) AS stage FROM k)
SELECT DISTINCT stage FROM s
""")
def q_change_plan(spark, sf_dir):
    changes = customer_diff(spark, sf_dir).withColumn("category", R.change_category(F.col("change_type"), F.col("name"), F.col("id") % 3 == 0, {"pptx": "deck"}))
    plan = spark.createDataFrame([(k, v) for k, v in STAGE_PLAN.items()], "category string, stages array<string>")
    return diff.stages_to_run(changes, plan).select(F.explode("stages").alias("stage"))


@query("""
WITH c AS (SELECT o_orderkey AS k, o_custkey AS g, CASE WHEN o_orderkey % 9 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS m FROM orders WHERE o_orderkey % 8 <> 0),
p AS (SELECT o_orderkey AS k, o_custkey AS g, o_totalprice AS m FROM orders WHERE o_orderkey % 10 <> 0),
d AS (SELECT coalesce(c.g, p.g) AS g, CASE WHEN p.k IS NULL THEN 'A' WHEN c.k IS NULL THEN 'R' WHEN c.m <> p.m THEN 'C' ELSE 'U' END AS s FROM c FULL OUTER JOIN p ON c.k = p.k AND c.g = p.g)
SELECT g, count(*) FILTER (s = 'A') AS added, count(*) FILTER (s = 'C') AS changed, count(*) FILTER (s = 'R') AS removed, count(*) FILTER (s = 'U') AS unchanged FROM d GROUP BY g HAVING count(*) FILTER (s <> 'U') > 0
""")
def q_asset_diff(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("g"), F.col("o_totalprice").alias("m"))
    cur = o.where("k % 8 <> 0").withColumn("m", F.when(F.col("k") % 9 == 0, F.col("m") + 1).otherwise(F.col("m")))
    out = diff.asset_diff(cur, o.where("k % 10 <> 0"), "g", "k", "m")
    return out.select("g", *[F.size(c).cast("long").alias(c) for c in ("added", "changed", "removed")], "unchanged")


@query("SELECT 'new' AS kind, doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'stale', doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def q_new_stale(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents").select("doc_id"), read(spark, sf_dir, "labels").select("doc_id")
    return diff.missing(docs, labels, "doc_id").select(F.lit("new").alias("kind"), "doc_id").union(diff.missing(labels, docs, "doc_id").select(F.lit("stale"), "doc_id"))


#: How page urls name a language and a number; the rule table of the path query.
PAGE_RULES = R.KeyRules(folders={"en": 1, "de": 2, "fr": 3, "es": 4}, words={}, key_word="page", most={1: 24, 2: 14, 3: 24, 4: 24}, weeks={1: [1, 2], 2: [3, 4]})


@query(r"""
SELECT page_id, CASE WHEN contains(lower(url), '/en/') THEN 1 WHEN contains(lower(url), '/de/') THEN 2 WHEN contains(lower(url), '/fr/') THEN 3 WHEN contains(lower(url), '/es/') THEN 4 END AS grp,
  lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)', 1)) AS host, CASE WHEN contains(lower(url), 'index') THEN 'index' WHEN contains(lower(url), 'page') THEN 'page' ELSE 'other' END AS kind FROM pages
""")
def q_path_keys(spark, sf_dir):
    u = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", R.group_of(u, PAGE_RULES).alias("grp"), T.host(u).alias("host"), R.first_match(u, [("index", "index"), ("page", "page")], "other").alias("kind"))


@query("""
WITH p AS (SELECT string_split(regexp_replace(url, '^[a-z]+://', ''), '/') AS s, length(html) AS b FROM pages),
f AS (SELECT array_to_string(list_slice(s, 1, i), '/') AS folder, b FROM (SELECT s, b, unnest(range(1, len(s))) AS i FROM p WHERE len(s) > 1))
SELECT folder, count(*) AS files, CAST(sum(b) AS BIGINT) AS bytes FROM f GROUP BY folder
""")
def q_path_rollup(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select(F.regexp_replace("url", "^[a-z]+://", "").alias("path"), F.length("html").alias("n")).where(F.contains("path", F.lit("/")))
    return rollup.path_rollup(pages, F.col("path"), F.col("n").cast("long"))


@query(r"""
WITH t AS (SELECT page_id, regexp_extract_all(regexp_replace(regexp_replace(html, '(?is)<(script|style)\b.*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?i)<a\b[^>]*?href="([^"]*)"', 1) AS u FROM pages),
e AS (SELECT page_id, unnest(u) AS url, unnest(range(0, len(u))) AS pos FROM t)
SELECT page_id, url, CAST(min(pos) AS INTEGER) AS pos FROM e GROUP BY page_id, url
""")
def q_links_per_page(spark, sf_dir):
    """Different links of each page with their first place."""
    return dedup.first_wins(page_links(read(spark, sf_dir, "pages")).select("page_id", "url", "pos"), ["page_id", "url"], ["pos"])


@query(r"""
WITH c AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<(script|style)\b.*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g') AS h FROM pages)
SELECT page_id, lower(regexp_extract(h, '(?i)<html[^>]*\blang="([a-zA-Z-]+)"', 1)) AS lang, trim(regexp_extract(h, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title,
  CAST(len(regexp_extract_all(h, '(?is)<p\b[^>]*>(.*?)</p>', 1)) AS INTEGER) AS n_paragraphs, CAST(len(regexp_extract_all(h, '(?is)<h[1-6]\b[^>]*>(.*?)</h[1-6]>', 1)) AS INTEGER) AS n_headings FROM c
""")
def q_parse_pages(spark, sf_dir):
    return parse_pages(read(spark, sf_dir, "pages")).select("page_id", "lang", "title", F.size("paragraphs").alias("n_paragraphs"), F.size("headings").alias("n_headings"))


@query()
def q_page_paragraphs(spark, sf_dir):
    """Paragraph atoms of the pages with their location path."""
    return page_paragraphs(read(spark, sf_dir, "pages"))


@query(r"""
WITH s AS (
  SELECT page_id AS item, 1.0 AS weight, regexp_extract(url, '/(en|de|fr|es)/', 1) AS candidate FROM pages
  UNION ALL SELECT page_id, 0.8, CASE WHEN page_id % 50 = 0 THEN 'xx' ELSE lower(regexp_extract(html, '(?i)<html[^>]*\blang="([a-zA-Z-]+)"', 1)) END FROM pages),
v AS (SELECT item, candidate, CAST(round(sum(weight), 6) AS DOUBLE) AS vote FROM s WHERE candidate <> '' GROUP BY ALL),
r AS (SELECT *, max(vote) OVER (PARTITION BY item) AS best, sum(vote) OVER (PARTITION BY item) AS total FROM v),
w AS (SELECT item, string_agg(candidate, ',' ORDER BY candidate) AS winners, max(best) AS vote, round(100 * max(best) / max(total), 2) AS confidence FROM r WHERE vote = best GROUP BY item)
SELECT item, winners, vote, confidence, CASE WHEN confidence >= 90 THEN 'high' WHEN confidence >= 70 THEN 'medium' WHEN confidence >= 50 THEN 'low' ELSE 'review' END AS status FROM w
""")
def q_lang_vote(spark, sf_dir):
    """A page's language by a weighted vote of its url and its html tag (every fiftieth tag is spoilt)."""
    pages = read(spark, sf_dir, "pages")
    tag = F.when(F.col("page_id") % 50 == 0, "xx").otherwise(F.lower(F.regexp_extract("html", r'(?i)<html[^>]*\blang="([a-zA-Z-]+)"', 1)))
    signal = lambda name, weight, c: pages.select(F.col("page_id").alias("item"), F.lit(name).alias("signal"), F.lit(weight).alias("weight"), F.lit(1.0).alias("confidence"), c.alias("candidate"))
    signals = signal("url", 1.0, F.regexp_extract("url", "/(en|de|fr|es)/", 1)).union(signal("tag", 0.8, tag)).where("candidate <> ''")
    return rollup.weighted_vote(signals).withColumn("winners", F.array_join("winners", ","))


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL")
def q_user_activity(spark, sf_dir):
    return read(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("SELECT user_id, event_id, rank FROM (SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rank FROM events) WHERE rank <= 5")
def q_latest_events(spark, sf_dir):
    """The five latest events of each user."""
    return rollup.top_n(read(spark, sf_dir, "events").select("user_id", "event_id", "ts"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 5).drop("ts")


@query("SELECT event_id, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000")
def q_history_cap(spark, sf_dir):
    """The latest 1000 rows of the history."""
    return read(spark, sf_dir, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(1000).select("event_id", "user_id")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def q_latest_order(spark, sf_dir):
    return rollup.latest(read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_orderdate", "o_orderkey").drop("o_orderdate")


@query("""
WITH n AS (SELECT l_suppkey AS k, count(*) AS n FROM lineitem GROUP BY 1), m AS (SELECT avg(n) AS a, stddev_pop(n) AS s FROM n)
SELECT k, n, round(CASE WHEN coalesce(s, 0) = 0 THEN 0 ELSE (n - a) / s END, 6) AS z, abs(CASE WHEN coalesce(s, 0) = 0 THEN 0 ELSE (n - a) / s END) > 2 AS outlier FROM n, m
""")
def q_volume_outliers(spark, sf_dir):
    counts = read(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("k")).agg(F.count("*").alias("n"))
    return rollup.outliers(counts, "n").withColumn("z", F.round("z", 6))


_TOKENS = f"list_filter(string_split({NORM}, ' '), lambda x: x <> '')"


@query(f"""
WITH w AS (SELECT doc_id, unnest(list_distinct({_TOKENS})) AS word FROM documents), n AS (SELECT count(*) AS n FROM documents)
SELECT word, count(*) AS df, count(*) > 0.2 * any_value(n) AS common FROM w, n GROUP BY word
""")
def q_doc_frequency(spark, sf_dir):
    return rollup.document_frequency(read(spark, sf_dir, "documents"), "doc_id", T.word_set(F.col("text")), 0.2)


@query(f"""
WITH w AS (SELECT DISTINCT lang, unnest({_TOKENS}) AS m FROM documents), s AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
p AS (SELECT a.lang AS a, b.lang AS b, count(*) AS shared FROM w a JOIN w b ON a.m = b.m AND a.lang < b.lang GROUP BY ALL)
SELECT x.lang AS a, y.lang AS b, coalesce(shared, 0) AS shared, coalesce(shared, 0) / (x.n + y.n - coalesce(shared, 0)) AS jaccard FROM s x JOIN s y ON x.lang < y.lang LEFT JOIN p ON p.a = x.lang AND p.b = y.lang
""")
def q_jaccard_langs(spark, sf_dir):
    words = read(spark, sf_dir, "documents").select("lang", F.explode(T.word_set(F.col("text"))).alias("m"))
    return rollup.set_overlap(words, "lang", "m")


@query(f"""
WITH d AS (SELECT doc_id, list_distinct({_TOKENS}) AS a, list_distinct(list_filter(string_split(trim(regexp_replace(lower(substring(text, 1, 400)), '[\\s\\x0B\\x1C-\\x1F\\x85\\p{{Z}}]+', ' ', 'g')), ' '), lambda x: x <> '')) AS b FROM documents),
s AS (SELECT doc_id, CASE WHEN len(a) = 0 THEN 1.0 ELSE len(list_intersect(a, b)) / len(a) END AS share FROM d)
SELECT doc_id, round(share, 9) AS share, CASE WHEN share >= 0.9 THEN 'PASS' WHEN share >= 0.5 THEN 'WARN' ELSE 'LOW' END AS band FROM s
""")
def q_word_containment(spark, sf_dir):
    """How much of each document's words a shortened copy keeps."""
    share = T.containment(F.col("text"), F.substring("text", 1, 400))
    out = read(spark, sf_dir, "documents").select("doc_id", share.alias("share"))
    return out.select("doc_id", F.round("share", 9).alias("share"), F.when(F.col("share") >= 0.9, "PASS").when(F.col("share") >= 0.5, "WARN").otherwise("LOW").alias("band"))


@query("""
WITH u AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations WHERE role = 'assistant')
SELECT coalesce(u.conv_id, a.conv_id) AS conv_id, CAST(coalesce(u.i, a.i) AS INTEGER) AS i, u.text AS a, a.text AS b FROM u FULL OUTER JOIN a ON u.conv_id = a.conv_id AND u.i = a.i
""")
def q_zip_turns(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    return reconcile.ordinal_zip(c.where("role = 'user'"), c.where("role = 'assistant'"), "conv_id", "turn", "text")


@query("SELECT conv_id, section, count(*) AS turns, CAST(sum(length(text)) AS BIGINT) AS chars FROM (SELECT *, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS section FROM conversations) GROUP BY ALL")
def q_sections(spark, sf_dir):
    """Turns grouped into islands that a user turn opens."""
    marked = rollup.islands(read(spark, sf_dir, "conversations"), ["conv_id"], "turn", F.col("role") == "user")
    return marked.groupBy("conv_id", "section").agg(F.count("*").alias("turns"), F.sum(F.length("text")).cast("long").alias("chars"))


def tpch_checks(spark, sf_dir) -> DataFrame:
    orders, items, customers = (read(spark, sf_dir, t) for t in ("orders", "lineitem", "customer"))
    out = expect(orders, [Rule("S001", "ERROR", F.col("o_orderkey").isNull(), "key present"), Rule("S002", "ERROR", ~F.col("o_orderstatus").isin("F", "O", "P"), "status in domain"), Rule("S003", "WARNING", ~(F.col("o_totalprice") > 1000), "price above 1000"), Rule("C001", "INFO", ~F.col("o_orderpriority").rlike("^[1-5]-"), "priority pattern", 2)])
    out = out.union(expect(items, [Rule("S010", "ERROR", ~F.col("l_discount").between(0, 0.1), "discount range"), Rule("C010", "WARNING", ~(F.col("l_quantity") <= 45), "quantity", 2, 0.2)]))
    out = out.union(expect(customers, [Rule("S020", "ERROR", F.trim("c_name") == "", "name present"), Rule("C020", "WARNING", F.col("c_acctbal") < 0, "balance", 4)]))
    out = out.union(unique(orders, ["o_orderkey"], "X001", "ERROR", 3)).union(referenced(orders, "o_custkey", customers, "c_custkey", "X002", "ERROR", 3))
    return out


_CHECKS = """
WITH k AS (
  SELECT 'S001' AS check_id, 1 AS layer, 'ERROR' AS severity, count(*) FILTER (o_orderkey IS NULL) AS failures, count(*) AS total, 0.0 AS allowed FROM orders
  UNION ALL SELECT 'S002', 1, 'ERROR', count(*) FILTER (coalesce(o_orderstatus NOT IN ('F', 'O', 'P'), true)), count(*), 0 FROM orders
  UNION ALL SELECT 'S003', 1, 'WARNING', count(*) FILTER (coalesce(NOT o_totalprice > 1000, true)), count(*), 0 FROM orders
  UNION ALL SELECT 'C001', 2, 'INFO', count(*) FILTER (coalesce(NOT regexp_matches(o_orderpriority, '^[1-5]-'), true)), count(*), 0 FROM orders
  UNION ALL SELECT 'S010', 1, 'ERROR', count(*) FILTER (coalesce(NOT l_discount BETWEEN 0 AND 0.1, true)), count(*), 0 FROM lineitem
  UNION ALL SELECT 'C010', 2, 'WARNING', count(*) FILTER (coalesce(NOT l_quantity <= 45, true)), count(*), 0.2 FROM lineitem
  UNION ALL SELECT 'S020', 1, 'ERROR', count(*) FILTER (coalesce(trim(c_name) = '', true)), count(*), 0 FROM customer
  UNION ALL SELECT 'C020', 4, 'WARNING', count(*) FILTER (coalesce(c_acctbal < 0, true)), count(*), 0 FROM customer
  UNION ALL SELECT 'X001', 3, 'ERROR', count(*) FILTER (n > 1), count(*), 0 FROM (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY 1)
  UNION ALL SELECT 'X002', 3, 'ERROR', count(*), count(*), 0 FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)),
c AS (SELECT check_id, CAST(layer AS INTEGER) AS layer, severity, failures <= allowed * total AS passed, failures, total FROM k)
"""


@query(_CHECKS + "SELECT check_id, layer, severity, passed, failures, total FROM c")
def q_expect_tpch(spark, sf_dir):
    return tpch_checks(spark, sf_dir).select("check_id", "layer", "severity", "passed", "failures", "total")


@query(_CHECKS + "SELECT layer, severity, count(*) AS total, count(*) FILTER (passed) AS ok, count(*) FILTER (NOT passed) AS failed FROM c GROUP BY CUBE (layer, severity)")
def q_qa_cube(spark, sf_dir):
    return quality_cube(tpch_checks(spark, sf_dir))


@query(_CHECKS + """, s AS (SELECT count(*) FILTER (NOT passed AND severity = 'ERROR') AS errors, count(*) FILTER (NOT passed AND severity = 'WARNING') AS warnings,
  CASE WHEN count(*) FILTER (layer = 4) = 0 THEN 0 ELSE count(*) FILTER (layer = 4 AND passed) / count(*) FILTER (layer = 4) END AS user_rate FROM c)
SELECT errors, warnings, CAST(user_rate AS DOUBLE) AS user_rate, CASE WHEN errors > 0 THEN 'FAIL' WHEN user_rate >= 1 THEN 'PASS' ELSE 'NEEDS_REVIEW' END AS verdict FROM s""")
def q_qa_verdict(spark, sf_dir):
    return verdict(tpch_checks(spark, sf_dir))


@query("""
WITH p AS (SELECT c_custkey AS k, c_acctbal AS x, c_name AS y FROM customer WHERE c_custkey % 17 <> 0), c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal END AS x, c_name AS y FROM customer WHERE c_custkey % 13 <> 0),
j AS (SELECT p.k AS pk, c.k AS ck, p.x AS px, c.x AS cx, p.y AS py, c.y AS cy FROM p FULL OUTER JOIN c ON p.k = c.k),
r AS (SELECT 'lost_rows' AS check_id, count(*) FILTER (ck IS NULL) AS failures FROM j UNION ALL SELECT 'lost_x', count(*) FILTER (px IS NOT NULL AND cx IS NULL AND ck IS NOT NULL) FROM j UNION ALL SELECT 'lost_y', count(*) FILTER (py IS NOT NULL AND cy IS NULL AND ck IS NOT NULL) FROM j)
SELECT check_id, failures, failures = 0 AS passed FROM r
""")
def q_regression(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("x"), F.col("c_name").alias("y"))
    return regression(c.where("k % 13 <> 0").withColumn("x", F.when(F.col("k") % 11 != 0, F.col("x"))), c.where("k % 17 <> 0"), "k", ["x", "y"])


@query("SELECT source, round(avg((CASE WHEN text IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN lang IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN n_chars >= 100 THEN 1 ELSE 0 END) / 3), 9) AS score FROM documents GROUP BY source")
def q_completeness(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").withColumn("n_chars", F.when(F.col("n_chars") >= 100, F.col("n_chars")))
    return docs.groupBy("source").agg(F.round(F.avg(completeness(docs, ["text", "lang", "n_chars"])), 9).alias("score"))


@query(f"""
WITH d AS (SELECT doc_id, {NORM} AS n, doc_id IN (SELECT doc_id FROM labels) AS l FROM documents)
SELECT doc_id, CASE WHEN n = '' OR n IS NULL THEN 'source' WHEN length(n) < 200 THEN 'non_empty' ELSE 'long' END AS last_seen, CASE WHEN n = '' OR n IS NULL THEN 'non_empty' WHEN length(n) < 200 THEN 'long' ELSE 'output' END AS lost_at FROM d WHERE NOT l
""")
def q_stage_loss(spark, sf_dir):
    """For unlabelled documents: the last stage (all, non-empty, long) that holds them, and where they were lost."""
    docs = read(spark, sf_dir, "documents").select("doc_id", T.norm(F.col("text")).alias("n"))
    lost = diff.missing(docs.select("doc_id"), read(spark, sf_dir, "labels"), "doc_id")
    full = docs.where(F.coalesce("n", F.lit("")) != "")
    return reconcile.attribute_loss(lost, [("source", docs), ("non_empty", full), ("long", full.where(F.length("n") >= 200))], "doc_id", "source")


@query("SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 10) + 1 AS BIGINT) AS batch FROM documents")
def q_batches(spark, sf_dir):
    return rollup.batches(read(spark, sf_dir, "documents").select("doc_id"), "doc_id", 10).select("doc_id", "batch")


_UNIT = "(CAST(('0x' || substring(md5(CAST(doc_id AS VARCHAR)), 1, 13)) AS BIGINT) + 1) / power(16, 13)"


@query(f"SELECT doc_id, lang FROM (SELECT doc_id, lang, -ln({_UNIT}) / greatest(n_chars, 1) AS k, row_number() OVER (PARTITION BY lang ORDER BY -ln({_UNIT}) / greatest(n_chars, 1), doc_id) AS r FROM documents) ORDER BY CASE WHEN r = 1 THEN 0 ELSE 1 END, k, doc_id LIMIT 50")
def q_weighted_sample(spark, sf_dir):
    """Fifty documents, likelier by length, at least one of each language."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return rollup.weighted_sample(docs, "doc_id", F.greatest("n_chars", F.lit(1)), 50, "lang").select("doc_id", "lang")


@query("""
WITH e AS (SELECT l.doc_id, 'q' || l.quality || 't' || l.toxic AS chk, CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 1 ELSE 2 END AS s FROM labels l),
r AS (SELECT *, row_number() OVER (PARTITION BY chk ORDER BY doc_id) AS r FROM e)
SELECT doc_id, chk FROM r WHERE r <= 2 ORDER BY s, chk, doc_id LIMIT 5
""")
def q_budget_sample(spark, sf_dir):
    e = read(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("q"), "quality", F.lit("t"), "toxic").alias("chk"), "quality", "toxic")
    rank = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    return rollup.budget_sample(e, "chk", rank, "doc_id", 2, 5).select("doc_id", "chk")


@query("SELECT lang, source, count(*) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY ROLLUP (lang, source)")
def q_rollup_totals(spark, sf_dir):
    return read(spark, sf_dir, "documents").rollup("lang", "source").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"))


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type, date_trunc('hour', ts)")
def q_event_dedup(spark, sf_dir):
    """One event for each user, type and hour."""
    e = read(spark, sf_dir, "events").select("user_id", "event_type", F.date_trunc("hour", "ts").alias("at"), "event_id")
    return dedup.first_wins(e, ["user_id", "event_type", "at"], ["event_id"]).select("user_id", "event_type", "event_id")


@query("SELECT (SELECT count(*) FROM documents WHERE lang = 'en') AS en, d.lang AS lang, d.source AS source, d.n AS n FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY GROUPING SETS ((lang), (source))) d")
def q_grouping_sets(spark, sf_dir):
    """Counts by language and by source in one pass."""
    docs = read(spark, sf_dir, "documents")
    en = docs.where("lang = 'en'").agg(F.count("*")).scalar()
    sets = docs.groupingSets([[F.col("lang")], [F.col("source")]], F.col("lang"), F.col("source")).agg(F.count("*").alias("n"))
    return sets.select(en.alias("en"), "lang", "source", "n")


@query("""
WITH g AS (SELECT s.source, l.lang FROM (SELECT DISTINCT source FROM documents) s, (VALUES ('en'), ('de'), ('fr'), ('es'), ('it')) l(lang))
SELECT source, lang FROM g WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.source = g.source AND d.lang = g.lang)
""")
def q_expected_grid(spark, sf_dir):
    """Which expected languages a source lacks: the expected grid is exploded from a constant list."""
    return tallies.missing_cells(read(spark, sf_dir, "documents"), "source", "lang", ["en", "de", "fr", "es", "it"])


@query("""
WITH v AS (SELECT doc_id % 97 AS record, doc_id AS attempt, CASE WHEN lang IN ('en', 'de') THEN 'lang' ELSE 'other' END AS field, source AS verdict FROM documents),
n AS (SELECT record, field, verdict, count(*) AS n, min(attempt) AS first FROM v GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY record, field ORDER BY n DESC, first) AS r, count(*) OVER (PARTITION BY record, field) AS kinds, sum(n) OVER (PARTITION BY record, field) AS votes FROM n)
SELECT record, field, verdict, kinds = 1 AS unanimous, CAST(votes AS BIGINT) AS votes FROM r WHERE r = 1
""")
def q_consensus(spark, sf_dir):
    """Majority verdict of a record's field, ties to the earliest attempt."""
    d = read(spark, sf_dir, "documents")
    v = d.select((F.col("doc_id") % 97).alias("record"), F.col("doc_id").alias("attempt"), F.when(F.col("lang").isin("en", "de"), "lang").otherwise("other").alias("field"), F.col("source").alias("verdict"))
    return rollup.consensus(v)


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n, count(*) FILTER (o_totalprice > 150000) AS large, count(*) FILTER (o_totalprice > 150000) / count(*) AS share FROM orders GROUP BY ALL")
def q_conditional_counts(spark, sf_dir):
    return tallies.conditional_counts(read(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"], F.col("o_totalprice") > 150000, "large")


@query("SELECT o_custkey, o_orderkey, place FROM (SELECT *, lag(o_orderstatus) OVER w AS before, row_number() OVER w AS place FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)) WHERE o_orderstatus = before OR o_orderkey = place")
def q_order_gaps(spark, sf_dir):
    """Orders that repeat the status of the customer's order before them, or whose number is their place."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    c = read(spark, sf_dir, "orders").withColumns({"before": F.lag("o_orderstatus").over(w), "place": F.row_number().over(w)})
    return c.where("o_orderstatus = before or o_orderkey = place").select("o_custkey", "o_orderkey", F.col("place").cast("long").alias("place"))
