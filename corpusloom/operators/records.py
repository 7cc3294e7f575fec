"""From text to records: slides, tables, continued blocks and labelled values of line tables, and one nested record for each key.

All are windows over the lines of one document, so they are parted by the document's id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .dedup import prefix_key, unsuppressed
from .rollup import lines

SLIDE = r"^#+\s*Slide\s+(\d+)"
RULE = r"^\s*(-{3,}|={3,}|\*{3,})\s*$"
NOTES = r"(?i)^\s*(?:#+\s*)?(?:\*\*)?(?:speaker\s+)?notes\s*:(?:\*\*)?\s*"


def slides(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, slide, body, notes: a heading line opens a slide, a notes line turns to its notes, rule lines are dropped."""
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    head = F.nullif(F.regexp_extract("line", SLIDE, 1), F.lit("")).cast("int")
    rows = lines(docs, key, text).withColumns({"slide": F.last(head, True).over(w), "opens": F.col("line").rlike(SLIDE)})
    inside = Window.partitionBy(key, "slide").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.where("slide is not null").withColumn("noted", F.max(F.col("line").rlike(NOTES)).over(inside)).where(~F.col("opens") & ~F.col("line").rlike(RULE))
    cut = F.regexp_replace("line", NOTES, "")
    of = lambda c: F.trim(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(c & (F.trim(cut) != ""), F.struct("line_no", cut.alias("t"))))), lambda x: x["t"]), "\n"))
    return rows.groupBy(key, "slide").agg(of(~F.col("noted")).alias("body"), of(F.col("noted")).alias("notes"))


def tables(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, table_no, headers, rows of pipe tables: a row of cells followed by a separator opens one, a line without pipes ends it."""
    w = Window.partitionBy(key).orderBy("line_no")
    bar, rule = F.trim("line").startswith("|"), F.trim("line").rlike(r"^\|[\s:|-]*-[\s:|-]*\|?$")
    rows = lines(docs, key, text).withColumns({"bar": bar, "rule": rule}).withColumns({"after": F.lead("rule").over(w), "before": F.lag("bar").over(w)})
    opens = F.col("bar") & ~F.col("rule") & F.coalesce("after", F.lit(False)) & ~F.coalesce("before", F.lit(False))
    run = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"table_no": F.sum(opens.cast("int")).over(run), "gap": F.sum((~F.col("bar")).cast("int")).over(run)})
    rows = rows.withColumn("home", F.first(F.when(opens, F.col("gap")), True).over(Window.partitionBy(key, "table_no"))).where(F.col("bar") & ~F.col("rule") & (F.col("table_no") > 0) & (F.col("gap") == F.col("home")))
    cells = F.transform(F.split(F.regexp_replace(F.trim("line"), r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    g = rows.groupBy(key, "table_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", cells.alias("c")))), lambda x: x["c"]).alias("r"))
    return g.select(key, "table_no", F.element_at("r", 1).alias("headers"), F.slice("r", F.lit(2), F.greatest(F.size("r") - 1, F.lit(0))).alias("rows"))


def table_kind(headers: Column, rows: Column, words: dict[str, list[str]], default: str = "data") -> Column:
    """The kind of a table by the words in its headers and first row: the first kind with two of its words or more, else the first with one."""
    first = F.coalesce(F.get(rows, F.lit(0)), F.array().cast("array<string>"))
    t = F.lower(F.concat(F.array_join(F.coalesce(headers, F.array().cast("array<string>")), " "), F.lit(" "), F.array_join(first, " ")))
    hits = {k: sum((F.contains(t, F.lit(w)).cast("int") for w in ws), F.lit(0)) for k, ws in words.items()}
    return F.coalesce(*[F.when(n >= least, F.lit(k)) for least in (2, 1) for k, n in hits.items()], F.lit(default))


def video_entries(refs: DataFrame, record: str = "record") -> DataFrame:
    """Video entries of records from references (record, ord, url, filename, video_id, type, title, path), null or empty where unknown: the first of each url, else file name, else id, numbered
    in order. A file has its path as url and its name as title where it has none; its id, where none is given, is the name's stem. Only files have ids."""
    from .dedup import first_wins, numbered

    told = lambda c: F.nullif(F.col(c), F.lit(""))
    known = refs.withColumn("key_", F.coalesce(told("url"), told("filename"), told("video_id"))).where("key_ is not null")
    is_file = F.coalesce(F.col("type") == "video_file", F.lit(False))
    title = F.when(is_file, F.coalesce(told("title"), told("filename"))).otherwise(F.coalesce(told("title"), told("url")))
    url, stem = F.when(is_file, F.col("path")).otherwise(F.col("url")), F.regexp_replace("filename", r"(?<=[^/])\.[^./]*$", "")
    video_id = F.when(told("filename").isNotNull(), F.coalesce(told("video_id"), F.regexp_extract(stem, "([^/]*)$", 1)))
    placed = numbered(first_wins(known, [record, "key_"], ["ord"]), [record], ["ord"], "order")
    empty = lambda c, name: F.coalesce(c, F.lit("")).alias(name)
    return placed.select(record, "order", empty(video_id, "video_id"), empty(title, "title"), empty(url, "url"), empty(F.col("type"), "type"))


def resource_entries(links: DataFrame, record: str = "record") -> DataFrame:
    """Resource entries (record, ord, resource) from links (record, ord, url, text): web and mail links that aren't videos, the first of each url, as `text - url` where the text says more than the url."""
    from .dedup import first_wins

    url, text = F.trim("url"), F.trim(F.coalesce("text", F.lit("")))
    web = links.withColumns({"url": url, "text": text}).where((F.col("url").startswith("http") | F.col("url").startswith("mailto:")) & ~T.is_video(F.col("url")))
    says = (F.length("text") > 3) & ~F.col("text").startswith("http")
    return first_wins(web, [record, "url"], ["ord"]).select(record, "ord", F.when(says, F.concat("text", F.lit(" - "), "url")).otherwise(F.col("url")).alias("resource"))


def continued(docs: DataFrame, prefixes: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, prefix, value: a line with a known prefix and the lines after it, up to a blank line, a heading or the next prefix."""
    known = "(?i)^\\s*(" + "|".join(prefixes) + r")\s*[:\-]\s*"
    rows = lines(docs, key, text).withColumn("p", F.lower(F.regexp_extract("line", known, 1)))
    ends = (F.trim("line") == "") | F.trim("line").startswith("#") | (F.col("p") != "")
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("island", F.sum(ends.cast("int")).over(w))
    g = rows.groupBy(key, "island").agg(F.max("p").alias("prefix"), F.array_sort(F.collect_list(F.struct("line_no", F.trim(F.regexp_replace("line", known, "")).alias("t")))).alias("b"))
    return g.where("prefix <> ''").select(key, "prefix", F.trim(F.array_join(F.transform("b", lambda x: x["t"]), " ")).alias("value")).where("value <> ''")


def latched(docs: DataFrame, trigger: str, key: str = "doc_id", text: str = "body", part: str = "slide", least: int = 5) -> DataFrame:
    """key, part, line_no, line of the lines after a trigger line, up to the end of the part."""
    rows = docs.select(key, part, F.posexplode(F.split(text, "\n")).alias("line_no", "line")).withColumn("hit", F.col("line").rlike(trigger))
    w = Window.partitionBy(key, part).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("on", F.max("hit").over(w)).where("on and not hit").select(key, part, "line_no", F.trim("line").alias("line")).where(F.length("line") >= least)


def labelled(text: Column, label: str) -> Column:
    """The value after a label, over line ends up to a blank line, white space collapsed; null if there is none."""
    got = F.regexp_extract(text, rf"(?is)\b{label}\s*[:\-]\s*(.+?)(?:\n\s*\n|$)", 1)
    return F.nullif(F.trim(F.regexp_replace(got, r"(?U)\s+", " ")), F.lit(""))


def bullets(text: Column) -> Column:
    """Items of a text that start with a bullet or a number."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(?m)^\s*(?:[-*•]|\d+[.)])\s+(.+)$"), F.lit(1)), lambda x: F.trim(x))


def first_title(slides_: DataFrame, key: str = "doc_id", skip: str = r"(?i)^(lesson|slide)\s*\d+$") -> DataFrame:
    """The first line of each document's slides that isn't a bare number heading."""
    rows = slides_.select(key, "slide", F.posexplode(F.split("body", "\n")).alias("line_no", "line")).where((F.trim("line") != "") & ~F.trim("line").rlike(skip))
    return rows.groupBy(key).agg(F.min(F.struct("slide", "line_no", F.trim("line").alias("t"))).alias("x")).select(key, F.col("x.t").alias("title"))


def questions(slides_: DataFrame, key: str = "doc_id") -> DataFrame:
    rows = slides_.select(key, "slide", F.posexplode(F.split("body", "\n")).alias("line_no", "line")).where(F.trim("line").endswith("?") & (F.length("line") > 10))
    return rows.groupBy(key).agg(F.min(F.struct("slide", "line_no", F.trim("line").alias("t"))).alias("x")).select(key, F.col("x.t").alias("question"))


def focus_points(slides_: DataFrame, pattern: str, low: int = 20, high: int = 300, key: str = "doc_id") -> DataFrame:
    """key, points: lines that match within a length band, near-equal beginnings once, in order."""
    rows = slides_.select(key, "slide", F.posexplode(F.split("body", "\n")).alias("line_no", "line")).where(F.col("line").rlike(pattern) & F.length("line").between(low, high))
    one = rows.groupBy(key, prefix_key(F.col("line")).alias("k")).agg(F.min(F.struct("slide", "line_no", F.trim("line").alias("t"))).alias("x"))
    return one.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]).alias("points"))


def resources(text: Column) -> Column:
    """Links of a text that aren't videos, those contained in others left out."""
    return unsuppressed(F.filter(T.urls(text), lambda u: ~T.is_video(u)))


def videos(text: Column) -> Column:
    return F.array_distinct(F.filter(T.urls(text), T.is_video))


def assemble(groups: DataFrame, fields: list[DataFrame], keys: list[str]) -> DataFrame:
    """One record for each key: the group row with the columns of every field table that has the key."""
    out = groups
    for f in fields:
        out = out.join(f, keys, "left")
    return out


def grouped(items: DataFrame, keys: list[str], order: str, kinds: list[str], kind: str = "kind") -> DataFrame:
    """Counts and ordered arrays of each kind of item, by key."""
    rest = [c for c in items.columns if c not in (*keys, kind)]
    item = F.struct(order, *[c for c in rest if c != order])
    aggs = [a for k in kinds for a in (F.count_if(F.col(kind) == k).alias(f"{k}_count"), F.array_sort(F.collect_list(F.when(F.col(kind) == k, item))).alias(k))]
    return items.groupBy(*keys).agg(*aggs)


def atoms(records: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, location, content: every string of the records' string and string-array fields."""
    def strings(f: str) -> Column:
        return F.transform(F.coalesce(f, F.array().cast("array<string>")), lambda x, i: F.struct(F.concat(F.lit(f"{f}:"), (i + 1).cast("string")).alias("location"), x.alias("content")))

    kinds = dict(records.dtypes)
    parts = [strings(f) if kinds[f] == "array<string>" else F.array(F.struct(F.lit(f).alias("location"), F.col(f).alias("content"))) for f in fields]
    return records.select(key, F.explode(F.concat(*parts)).alias("a")).select(key, "a.*").where("content is not null and trim(content) <> ''")
