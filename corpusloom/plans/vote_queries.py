"""Queries of the six-signal vote, of label scores of assembled records and of template records, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assembly, templates, votes
from ..session import saved
from .queries import query, read

WORDS = {1: ["the", "thing"], 2: ["der", "ung"], 3: ["les", "eau"], 4: ["que", "ción"], 5: ["and the", "tion"], 6: ["die", "ein"]}
VOTING = votes.Voting(
    keys=[1, 2, 3, 4, 5, 6], weights={"path": 1.0, "parent": 1.0, "metadata": 0.95, "tags": 0.8, "content": 0.7, "volume": 0.5}, weeks={1: [1, 2], 2: [3, 4], 3: [5, 6]}, every=["Teacher Guide"],
    parents=[("the_tale", [3, 4]), ("tale", [6])], words=WORDS, volumes={"en": (20, 45), "de": (1, 30)},
)
INVENTORY = [(1, "src1", "Lesson 4"), (2, "src1", "All Lessons"), (3, "src2/", "All Lessons"), (4, "src3", "Lessons 2-3"), (5, "src", "none"), (6, "src5", "x - y"), (7, "src5", "Lesson 6")]


def voters(spark, sf_dir):
    """Documents as items: paths of several forms, every fourth with keys it came with, its first words as tags."""
    i, d = F.col("doc_id"), read(spark, sf_dir, "documents")
    name = F.when(i % 11 == 0, "teacher-guide").when(i % 7 == 0, F.concat(F.lit("Weeks "), (i % 3).cast("string"), F.lit("-3"))).when(i % 5 == 0, F.concat(F.lit("week_"), (i % 4).cast("string"))).when(i % 3 == 0, "the tale clip").otherwise(F.concat(F.lit("Lesson "), (i % 9).cast("string")))
    known = F.when(i % 4 == 0, F.array((i % 6 + 1).cast("int"), (i % 5 + 1).cast("int")))
    return d.select(i.alias("item"), F.concat("source", F.lit("/"), name).alias("path"), F.when(i % 13 == 0, "tale").alias("batch"), known.alias("known"), F.lit(0.9).alias("known_confidence"), F.slice(F.split(F.coalesce("text", F.lit("")), " ", 4), 1, 3).alias("tags"), "text", F.col("lang").alias("kind"))


def voted(spark, sf_dir):
    inventory = spark.createDataFrame(INVENTORY, "ord int, path string, keys string")
    return votes.consensus(votes.signals(voters(spark, sf_dir), VOTING, inventory), VOTING)


_WORDS = " UNION ALL ".join(f"SELECT {k} AS key, '{w}' AS w" for k, ws in WORDS.items() for w in ws)
_VOTED = rf"""
WITH items AS (
  SELECT doc_id AS item, source || '/' || CASE WHEN doc_id % 11 = 0 THEN 'teacher-guide' WHEN doc_id % 7 = 0 THEN 'Weeks ' || (doc_id % 3) || '-3' WHEN doc_id % 5 = 0 THEN 'week_' || (doc_id % 4) WHEN doc_id % 3 = 0 THEN 'the tale clip' ELSE 'Lesson ' || (doc_id % 9) END AS path,
    CASE WHEN doc_id % 13 = 0 THEN 'tale' ELSE '' END AS batch, CASE WHEN doc_id % 4 = 0 THEN [doc_id % 6 + 1, doc_id % 5 + 1] ELSE [] END AS known, string_split(coalesce(text, ''), ' ')[1:3] AS tags, lower(coalesce(text, '')) AS text, lang AS kind FROM documents),
words AS ({_WORDS}),
p AS (SELECT *, lower(trim(path || ' ' || batch)) AS c FROM items),
w AS (SELECT *, TRY_CAST(regexp_extract(c, 'weeks?[_\s\-]*(\d)[_\s\-]*(\d)', 1) AS INTEGER) AS wa, TRY_CAST(regexp_extract(c, 'weeks?[_\s\-]*(\d)[_\s\-]*(\d)', 2) AS INTEGER) AS wb, TRY_CAST(regexp_extract(c, 'lesson[_\s\-]*(\d{{1,2}})', 1) AS INTEGER) AS le,
  CASE WHEN regexp_matches(c, 'weeks?[_\s\-]*\d[_\s\-]*\d') THEN NULL ELSE TRY_CAST(regexp_extract(c, 'week[_\s\-]*(\d)', 1) AS INTEGER) END AS wk FROM p),
sp AS (SELECT *, [k FOR k IN [1, 2, 3, 4, 5, 6] IF (k + 1) // 2 BETWEEN wa AND wb] AS span FROM w),
path AS (SELECT item, CASE WHEN contains(replace(replace(c, '_', ' '), '-', ' '), 'teacher guide') THEN {{'f': 0.95, 'k': [1, 2, 3, 4, 5, 6]}} WHEN wa IS NOT NULL AND len(span) > 0 THEN {{'f': 0.9, 'k': span}} WHEN len(known) > 0 THEN {{'f': 0.9, 'k': known}}
  WHEN le BETWEEN 1 AND 6 THEN {{'f': 1.0, 'k': [le]}} WHEN wk BETWEEN 1 AND 3 THEN {{'f': 0.9, 'k': [2 * wk - 1, 2 * wk]}} END AS s FROM sp),
parent AS (SELECT item, CASE WHEN contains(path, 'the_tale') OR contains(path, 'the tale') THEN {{'f': 1.0, 'k': [3, 4]}} WHEN contains(path, 'tale') THEN {{'f': 1.0, 'k': [6]}} END AS s FROM items),
meta AS (SELECT item, CASE WHEN contains(path, 'src1') THEN {{'f': 0.95, 'k': [4]}} WHEN contains(path, 'src2/') THEN {{'f': 0.85, 'k': [1, 2, 3, 4, 5, 6]}} WHEN contains(path, 'src3') THEN {{'f': 0.95, 'k': [2, 3]}} WHEN contains(path, 'src5') THEN {{'f': 0.95, 'k': [6]}} END AS s FROM (SELECT item, lower(path) AS path FROM items)),
tg AS (SELECT item, replace(replace(lower(unnest(tags)), '-', ' '), '_', ' ') AS t FROM items),
tk AS (SELECT item, key, sum(CASE WHEN contains(w, t) OR contains(t, w) THEN 1.0 WHEN len(list_filter(string_split(w, ' '), lambda x: contains(t, x))) > 0 THEN 0.5 ELSE 0 END) AS n FROM tg, words GROUP BY ALL),
tb AS (SELECT item, {{'f': least(max(n) / 3, 1.0), 'k': list(key) FILTER (n = m)}} AS s FROM (SELECT *, max(n) OVER (PARTITION BY item) AS m FROM tk) WHERE m > 0 GROUP BY item),
ck AS (SELECT item, key, count(*) FILTER (contains(text, w)) AS n FROM items, words GROUP BY ALL),
cb AS (SELECT item, {{'f': least(max(n) / 4, 1.0), 'k': list(key) FILTER (n = m)}} AS s FROM (SELECT *, max(n) OVER (PARTITION BY item) AS m FROM ck) WHERE m > 0 GROUP BY item),
vol AS (SELECT kind, key, count(*) AS n FROM (SELECT kind, unnest(known) AS key FROM items) GROUP BY ALL),
vc AS (SELECT item, {{'f': CASE WHEN vol.n BETWEEN CASE i.kind WHEN 'en' THEN 20 WHEN 'de' THEN 1 ELSE 5 END AND CASE i.kind WHEN 'en' THEN 45 WHEN 'de' THEN 30 ELSE 50 END THEN 0.8 WHEN vol.n > 0 THEN 0.5 ELSE 0.3 END, 'k': known}} AS s FROM items i LEFT JOIN vol ON vol.kind = i.kind AND vol.key = i.known[1] WHERE len(known) > 0),
sig AS (SELECT item, 'path' AS signal, 1.0 AS w, CAST(s.f AS DOUBLE) AS f, s.k AS k FROM path WHERE s IS NOT NULL UNION ALL SELECT item, 'parent', 1.0, s.f, s.k FROM parent WHERE s IS NOT NULL UNION ALL SELECT item, 'metadata', 0.95, s.f, s.k FROM meta WHERE s IS NOT NULL
  UNION ALL SELECT item, 'tags', 0.8, s.f, s.k FROM tb UNION ALL SELECT item, 'content', 0.7, s.f, s.k FROM cb UNION ALL SELECT item, 'volume', 0.5, s.f, s.k FROM vc),
ef AS (SELECT *, CAST(round(CAST(w AS DECIMAL(6,3)) * CAST(f AS DECIMAL(9,6)) * CASE WHEN signal IN ('path', 'parent') AND f >= 0.9 THEN 1.5 ELSE 1.0 END, 9) AS DECIMAL(20,9)) AS e, signal IN ('path', 'parent') AND f >= 0.9 AS sure FROM sig),
vt AS (SELECT item, key, sum(e) AS v FROM (SELECT item, e, unnest(list_distinct(k)) AS key FROM ef) GROUP BY ALL),
tot AS (SELECT item, sum(e) AS total, bool_or(sure) AS sure, count(*) AS n FROM ef GROUP BY item),
best AS (SELECT item, max(v) AS b, string_agg(key, ',' ORDER BY key) FILTER (v = m) AS winners FROM (SELECT *, max(v) OVER (PARTITION BY item) AS m FROM vt) GROUP BY item),
res AS (SELECT i.item, coalesce(winners, '') AS winners, coalesce(n, 0) AS n_signals, CASE WHEN b IS NULL THEN 0.0 ELSE least(100.0, CAST(b AS DOUBLE) / CAST(total AS DOUBLE) * 100 * CASE WHEN sure THEN 1.1 ELSE 1.0 END) END AS share FROM items i LEFT JOIN tot USING (item) LEFT JOIN best USING (item)),
fin AS (SELECT *, CASE WHEN winners = '' THEN 'UNMAPPED' WHEN share >= 90 THEN 'HIGH_CONFIDENCE' WHEN share >= 70 THEN 'MEDIUM_CONFIDENCE' WHEN share >= 50 THEN 'LOW_CONFIDENCE' ELSE 'UNCERTAIN' END AS status FROM res)
"""


@query(_VOTED + "SELECT item, winners, n_signals, CAST(round(share, 1) AS DOUBLE) AS confidence, status FROM fin")
def q_six_votes(spark, sf_dir):
    """Keys of documents by the vote of path, parent, metadata, tags, content and volume."""
    return voted(spark, sf_dir).select("item", F.array_join("winners", ",").alias("winners"), F.size("signals").cast("long").alias("n_signals"), "confidence", "status")


@query(_VOTED + "SELECT count(*) AS items, count(*) FILTER (status IN ('HIGH_CONFIDENCE', 'MEDIUM_CONFIDENCE', 'LOW_CONFIDENCE')) AS mapped, count(*) FILTER (status IN ('UNCERTAIN', 'UNMAPPED')) AS unmapped, count(*) FILTER (status = 'HIGH_CONFIDENCE') AS high, count(*) FILTER (status = 'MEDIUM_CONFIDENCE') AS medium, count(*) FILTER (status = 'LOW_CONFIDENCE') AS low FROM fin")
def q_mapping_summary(spark, sf_dir):
    """Items by status of their vote."""
    return votes.mapping_summary(voted(spark, sf_dir))


@query(_VOTED + "SELECT CAST(unnest(string_split(winners, ',')) AS INTEGER) AS key, item FROM fin WHERE winners <> ''")
def q_key_index(spark, sf_dir):
    """The items of each key."""
    return votes.key_index(saved(spark)(voted(spark, sf_dir).select("item", "winners")))


LABELS = {"Articles": ["the ", " les ", "der "], "Endings": ["tion", "ung ", "ción"], "Links": [" and ", " et ", " und "], "Rare": ["zq", "wx"]}
REST = {"Anything": ["a", "e"], "Marks": ["%", "#"]}
_SCORE = " UNION ALL ".join(f"SELECT {i} AS place, '{k}' AS label, '{p}' AS p, {'true' if t is LABELS else 'false'} AS main" for t in (LABELS, REST) for i, (k, ps) in enumerate(t.items()) for p in ps)


@query(f"""
WITH l AS ({_SCORE}), d AS (SELECT page_id, lower(html) AS t, lower(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS h FROM pages),
s AS (SELECT page_id, main, place, label, count(*) FILTER (contains(t, p)) + CASE WHEN main THEN 2 * count(*) FILTER (contains(h, p)) ELSE 0 END AS n FROM d, l GROUP BY page_id, main, place, label),
b AS (SELECT page_id, main, arg_min(label, place) AS label FROM (SELECT *, max(n) OVER (PARTITION BY page_id, main) AS m FROM s) WHERE n = m AND n > 0 GROUP BY page_id, main)
SELECT d.page_id, coalesce(x.label, y.label, '') AS label FROM d LEFT JOIN b x ON x.page_id = d.page_id AND x.main LEFT JOIN b y ON y.page_id = d.page_id AND NOT y.main
""")
def q_best_labels(spark, sf_dir):
    """The best-scoring label of each page, its title counting more; ties go to the first label."""
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", votes.best_label(F.col("html"), F.regexp_extract("html", "<title>([^<]*)</title>", 1), LABELS, REST).alias("label"))


PLAN = [
    assembly.Field("title", (("page", "h1"), ("page", "title"))),
    assembly.Field("language", (("page", "lang"), ("url", "lang"))),
    assembly.Field("topics", (("page", "anchors"),), "list", 4),
    assembly.Field("resources", (("url", "url"), ("page", "hrefs")), "list", 3, merge=True),
    assembly.Field("n_topics", (("page", "anchors"),), "count"),
]


def page_sources(spark, sf_dir):
    """Pages and their urls as sources of records; every third page has no heading, every fourth no language of its own."""
    p, i = read(spark, sf_dir, "pages"), F.col("page_id")
    found = lambda pattern: F.nullif(F.regexp_extract("html", pattern, 1), F.lit(""))
    every = lambda n: F.regexp_extract_all("html", F.lit('<a href="([^"]*)">([^<]*)</a>'), F.lit(n))
    page = p.select(i.alias("key"), F.lit(1).alias("ord"), F.when(i % 3 > 0, found("<h1>([^<]*)</h1>")).alias("h1"), found("<title>([^<]*)</title>").alias("title"), F.when(i % 4 > 0, found('lang="([a-z]+)"')).alias("lang"), every(2).alias("anchors"), every(1).alias("hrefs"))
    return {"page": page, "url": p.select(i.alias("key"), F.lit(1).alias("ord"), "url", F.regexp_extract("url", "/(en|de|fr|es)/", 1).alias("lang"))}


@query(r"""
WITH p AS (SELECT page_id AS key, url, CASE WHEN page_id % 3 > 0 THEN trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)) ELSE '' END AS h1, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title, CASE WHEN page_id % 4 > 0 THEN regexp_extract(html, 'lang="([a-z]+)"', 1) ELSE '' END AS l1, regexp_extract(url, '/(en|de|fr|es)/', 1) AS l2,
  regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS t, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h FROM pages),
a AS (SELECT key, trim(unnest(t)) AS v, unnest(range(1, len(t) + 1)) AS i FROM p), b AS (SELECT key, v, min(i) AS i FROM a WHERE v <> '' GROUP BY ALL), c AS (SELECT key, count(*) AS n, list(v ORDER BY i)[1:4] AS topics FROM b GROUP BY key),
u AS (SELECT key, trim(unnest([url] || h)) AS v, unnest(range(0, len(h) + 1)) AS i FROM p), w AS (SELECT key, v, min(i) AS i FROM u WHERE v <> '' GROUP BY ALL), x AS (SELECT key, list(v ORDER BY i)[1:3] AS resources FROM w GROUP BY key)
SELECT p.key, coalesce(nullif(h1, ''), nullif(title, '')) AS title, coalesce(nullif(l1, ''), nullif(l2, '')) AS language, coalesce(topics, []) AS topics, coalesce(resources, []) AS resources, coalesce(n, 0) AS n_topics FROM p LEFT JOIN c USING (key) LEFT JOIN x USING (key)
""")
def q_assembled_records(spark, sf_dir):
    """Records of pages by a plan of fields."""
    return assembly.assemble(read(spark, sf_dir, "pages").select(F.col("page_id").alias("key")), page_sources(spark, sf_dir), PLAN)


TEMPLATES = templates.Plan(
    kinds=(("portfolio.*deck", "assessment"), ("pitch", "showcase"), ("rubric|assessment.*guide", "product")), components={"assessment": (25, "Portfolio"), "showcase": (25, "Pitch"), "product": (50, "Rubric")},
    skip="exemplar", terms=(("/en/", "1"), ("/de/", "2"), ("/fr/", "3")), lessons=((1, 24), (2, 12)), purpose="{label} template of the corpus", skills=("er", "que", "the"), criteria=("a", "ein"), levels=("en", "un"), most=3,
)
#: A page as lines: bullets, headings and table rows by their marks.
MARKUP = [("<li[^>]*>", "\n- "), ("<tr[^>]*>", "\n|"), ("<t[dh][^>]*>", " | "), ("<h[1-6][^>]*>", "\n# "), ("<(p|div|nav|article|table|aside)[^>]*>|</(p|li|h[1-6]|div|nav|article|table|aside|title)>", "\n"), ("<[^>]*>", "")]
_LINES = "html"
for _old, _new in MARKUP:
    _LINES = f"regexp_replace({_LINES}, '{_old}', '{_new}', 'g')"


@query(rf"""
WITH f AS (SELECT page_id AS file, url AS path, CASE page_id % 6 WHEN 0 THEN 'Portfolio ' || page_id || ' Deck.pptx' WHEN 1 THEN 'Pitch.' || page_id || '.md' WHEN 2 THEN 'a rubric_' || page_id WHEN 3 THEN 'Rubric exemplar.md' WHEN 4 THEN 'Assessment - guide.docx' ELSE 'notes.md' END AS name FROM pages),
k AS (SELECT *, CASE WHEN contains(t, 'exemplar') THEN NULL WHEN regexp_matches(t, 'portfolio.*deck') THEN 'assessment' WHEN contains(t, 'pitch') THEN 'showcase' WHEN regexp_matches(t, 'rubric|assessment.*guide') THEN 'product' END AS component FROM (SELECT *, lower(name || ' ' || path) AS t FROM f)),
s AS (SELECT page_id AS file, 0 AS source, string_split({_LINES}, chr(10)) AS ls FROM pages UNION ALL SELECT doc_id, 1, string_split(coalesce(text, ''), chr(10)) FROM documents WHERE doc_id IN (SELECT page_id FROM pages)),
l AS (SELECT file, source, i, regexp_replace(x, '^\s+|\s+$', '', 'g') AS v FROM (SELECT file, source, unnest(ls) AS x, unnest(range(len(ls))) AS i FROM s)),
b AS (SELECT file, source, i, regexp_replace(regexp_replace(v, '^[-•*]+', ''), '^\s+|\s+$', '', 'g') AS v FROM l WHERE regexp_matches(v, '^[-•*]')),
c AS (SELECT file, source, i, j, regexp_replace(x, '^\s+|\s+$', '', 'g') AS v FROM (SELECT file, source, i, unnest(cs) AS x, unnest(range(len(cs))) AS j FROM (SELECT *, string_split(regexp_replace(v, '^\|+|\|+$', '', 'g'), '|') AS cs FROM l WHERE v LIKE '|%'))),
p AS (SELECT file, arg_min(substr(v, 1, 500), (source, i)) AS purpose FROM l WHERE NOT regexp_matches(v, '^[|#]') AND length(v) >= 40 GROUP BY file),
sk AS (SELECT file, list(v ORDER BY source, i)[1:3] AS core_skills FROM b WHERE length(v) >= 10 AND regexp_matches(lower(v), 'er|que|the') GROUP BY file),
cr AS (SELECT file, list(v ORDER BY source, i, j)[1:3] AS criteria FROM (SELECT file, source, i, 0 AS j, v FROM b WHERE length(v) >= 10 AND NOT regexp_matches(lower(v), 'er|que|the') AND regexp_matches(lower(v), 'a|ein') UNION ALL SELECT * FROM c WHERE length(v) > 20 AND regexp_matches(lower(v), 'en|un')) GROUP BY file),
n AS (SELECT *, regexp_replace(name, '^(.+)\.[^.]*$', '\1') AS stem, CASE WHEN contains(lower(path), '/en/') THEN 1 WHEN contains(lower(path), '/de/') THEN 2 WHEN contains(lower(path), '/fr/') THEN 3 END AS term FROM k WHERE component IS NOT NULL)
SELECT file, trim(regexp_replace(lower(stem), '[^a-z0-9]+', '-', 'g'), '-') AS id, stem AS template_name, component AS programme_component,
  coalesce(purpose, CASE component WHEN 'assessment' THEN 'Portfolio' WHEN 'showcase' THEN 'Pitch' ELSE 'Rubric' END || ' template of the corpus') AS purpose, CASE component WHEN 'product' THEN 50 ELSE 25 END AS weighting_percent,
  list_transform(range(1, CASE term WHEN 1 THEN 25 WHEN 2 THEN 13 ELSE 1 END), lambda i: 'Lesson ' || i) AS linked_lessons, coalesce(core_skills, []) AS core_skills, coalesce(criteria, []) AS criteria, term, path AS link
FROM n LEFT JOIN p USING (file) LEFT JOIN sk USING (file) LEFT JOIN cr USING (file)
""")
def q_template_records(spark, sf_dir):
    """Template records of pages named as templates; contents are the page's lines, then those of the document of the same number."""
    p, i, lines = read(spark, sf_dir, "pages"), F.col("page_id"), F.col("html")
    for old, new in MARKUP:
        lines = F.regexp_replace(lines, old, new)
    n = i.cast("string")
    name = F.when(i % 6 == 0, F.concat(F.lit("Portfolio "), n, F.lit(" Deck.pptx"))).when(i % 6 == 1, F.concat(F.lit("Pitch."), n, F.lit(".md"))).when(i % 6 == 2, F.concat(F.lit("a rubric_"), n)).when(i % 6 == 3, "Rubric exemplar.md").when(i % 6 == 4, "Assessment - guide.docx").otherwise("notes.md")
    files = p.select(i.alias("file"), name.alias("name"), F.col("url").alias("path"), F.lit("").alias("link"))
    pages = p.select(i.alias("file"), F.lit(0).alias("source"), F.lit(0).alias("ord"), lines.alias("text"))
    return templates.template_records(files, pages.unionByName(read(spark, sf_dir, "documents").select(F.col("doc_id").alias("file"), F.lit(1).alias("source"), F.lit(0).alias("ord"), "text")), TEMPLATES)
