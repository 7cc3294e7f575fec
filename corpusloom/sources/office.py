"""Office files (zipped XML) as tables. A data source opens the archives, see archive_source; the XML is taken apart by Spark's xpath and patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .archive_source import OfficeParts


def unzip(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """path, size, entry (null for a file without any), xml (null for media), error (null unless the file can't be opened) of all files that match glob."""
    spark.dataSource.register(OfficeParts)
    return spark.read.format("office_parts").option("path", root).option("glob", glob).load()


def _bare(xml):
    """XML without its declaration, which xpath functions don't take with some encodings."""
    return F.regexp_replace(xml, r"^\s*(?:\x{FEFF})?<\?xml[^>]*\?>", "")


def relations(parts: DataFrame) -> DataFrame:
    """path, owner (the entry that has the relation), rid, target, external."""
    rels = parts.where(F.col("entry").endswith(".rels")).withColumn("x", _bare(F.col("xml")))
    owner = F.regexp_replace(F.regexp_replace("entry", r"_rels/", ""), r"\.rels$", "")
    get = lambda a: F.expr(f"xpath(x, \"//*[name()='Relationship']/@{a}\")")
    z = rels.select("path", owner.alias("owner"), F.arrays_zip(get("Id").alias("rid"), get("Target").alias("target")).alias("z"))
    return z.select("path", "owner", F.explode("z").alias("z")).select("path", "owner", F.col("z.rid").alias("rid"), F.col("z.target").alias("target"), F.col("z.target").rlike("^[a-z]+:").alias("external"))


def slide_number(entry):
    return F.regexp_extract(entry, r"slides?/(?:notesSlide|slide)(\d+)\.xml$", 1).cast("int")


def decoded(text):
    """XML text with its entities as characters."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def every(xml, tag: str):
    """All elements of a tag, in order, as XML; elements of one tag inside each other aren't told apart."""
    return F.regexp_extract_all(xml, F.lit(rf"(?s)<{tag}(?:\s(?:[^>/]|/(?!>))*)?>.*?</{tag}>"), F.lit(0))


def runs(xml, tag: str):
    """The text of all runs, joined."""
    return decoded(F.array_join(F.regexp_extract_all(xml, F.lit(rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), F.lit(1)), ""))


def deck_slides(parts: DataFrame) -> DataFrame:
    """path, slide, texts (runs of each paragraph joined, empty ones left out) of every slide of a deck."""
    s = parts.where(F.col("entry").rlike(r"^ppt/slides/slide\d+\.xml$")).withColumn("x", _bare(F.col("xml")))
    texts = F.filter(F.transform(every("x", "a:p"), lambda p: runs(p, "a:t")), lambda t: F.trim(t) != "")
    return s.select("path", slide_number(F.col("entry")).alias("slide"), texts.alias("texts"))


def _table_rows(tables, row: str, cell: str, text: str):
    return F.transform(tables, lambda t: F.transform(every(t, row), lambda r: F.transform(every(r, cell), lambda c: F.trim(runs(c, text)))))


def deck_tables(parts: DataFrame) -> DataFrame:
    """path, slide, table_no, headers (the first row) and rows of the tables of decks."""
    s = parts.where(F.col("entry").rlike(r"^ppt/slides/slide\d+\.xml$")).withColumn("x", _bare(F.col("xml")))
    each = s.select("path", slide_number(F.col("entry")).alias("slide"), F.posexplode(_table_rows(every("x", "a:tbl"), "a:tr", "a:tc", "a:t")).alias("table_no", "r"))
    return each.select("path", "slide", "table_no", F.try_element_at("r", F.lit(1)).alias("headers"), F.slice("r", 2, F.greatest(F.size("r") - 1, F.lit(0))).alias("rows"))


def doc_tables(parts: DataFrame) -> DataFrame:
    """path, table_no, headers (the first row) and rows of the tables of text documents."""
    d = parts.where("entry = 'word/document.xml'").withColumn("x", _bare(F.col("xml")))
    each = d.select("path", F.posexplode(_table_rows(every("x", "w:tbl"), "w:tr", "w:tc", "w:t")).alias("table_no", "r"))
    return each.select("path", "table_no", F.try_element_at("r", F.lit(1)).alias("headers"), F.slice("r", 2, F.greatest(F.size("r") - 1, F.lit(0))).alias("rows"))


def deck_notes(parts: DataFrame) -> DataFrame:
    """path, slide, notes, through the relation of the slide to its notes page."""
    notes = parts.where(F.col("entry").rlike(r"^ppt/notesSlides/notesSlide\d+\.xml$")).withColumn("x", _bare(F.col("xml")))
    text = notes.select("path", F.regexp_extract("entry", r"([^/]+)$", 1).alias("file"), F.array_join(F.expr("xpath(x, \"//*[name()='a:t']/text()\")"), " ").alias("notes"))
    link = relations(parts).where(F.col("owner").rlike(r"slides/slide\d+\.xml$") & F.col("target").contains("notesSlide")).select("path", slide_number(F.col("owner")).alias("slide"), F.regexp_extract("target", r"([^/]+)$", 1).alias("file"))
    return link.join(text, ["path", "file"]).select("path", "slide", "notes")


def deck_links(parts: DataFrame) -> DataFrame:
    """path, slide, url of external links that a slide uses; jumps between slides are left out."""
    r = relations(parts).where(F.col("owner").rlike(r"slides/slide\d+\.xml$") & F.col("target").rlike("^(https?|mailto):"))
    used = parts.where(F.col("entry").rlike(r"^ppt/slides/slide\d+\.xml$")).withColumn("x", _bare(F.col("xml"))).select("path", F.col("entry").alias("owner"), F.explode(F.expr("xpath(x, \"//*[name()='a:hlinkClick']/@*\")")).alias("rid"))
    return r.join(used.distinct(), ["path", "owner", "rid"], "left_semi").select("path", slide_number(F.col("owner")).alias("slide"), F.col("target").alias("url"))


def deck_images(parts: DataFrame, require_use: bool = True) -> DataFrame:
    """path, image, slides (sorted): media files and the slides they are on; require_use: only where the slide embeds the relation."""
    r = relations(parts).where(F.col("owner").rlike(r"slides/slide\d+\.xml$") & F.col("target").contains("media/"))
    if require_use:
        used = parts.where(F.col("entry").rlike(r"^ppt/slides/slide\d+\.xml$")).withColumn("x", _bare(F.col("xml"))).select("path", F.col("entry").alias("owner"), F.explode(F.expr("xpath(x, \"//*[name()='a:blip']/@*\")")).alias("rid"))
        r = r.join(used.distinct(), ["path", "owner", "rid"], "left_semi")
    media = parts.where(F.col("entry").contains("/media/")).select("path", F.regexp_extract("entry", r"([^/]+)$", 1).alias("image"))
    on = r.select("path", F.regexp_extract("target", r"([^/]+)$", 1).alias("image"), slide_number(F.col("owner")).alias("slide"))
    found = on.groupBy("path", "image").agg(F.array_sort(F.collect_set("slide")).alias("slides"))
    return media.join(found, ["path", "image"], "left").select("path", "image", F.coalesce("slides", F.array().cast("array<int>")).alias("slides"))


def doc_paragraphs(parts: DataFrame) -> DataFrame:
    """path, pos, style, text of the non-empty paragraphs of text documents."""
    d = parts.where("entry = 'word/document.xml'").withColumn("x", _bare(F.col("xml")))
    each = d.select("path", F.posexplode(F.regexp_extract_all("x", F.lit(r"(?s)<w:p[ >].*?</w:p>"), F.lit(0))).alias("pos", "p"))
    text = F.array_join(F.regexp_extract_all("p", F.lit(r"(?s)<w:t(?:\s[^>]*)?>(.*?)</w:t>"), F.lit(1)), "")
    text = decoded(text)
    return each.select("path", "pos", F.nullif(F.regexp_extract("p", r'<w:pStyle w:val="([^"]*)"', 1), F.lit("")).alias("style"), text.alias("text")).where("trim(text) <> ''")


def doc_links(parts: DataFrame) -> DataFrame:
    """path, url of the web and mail links of text documents."""
    return relations(parts).where("owner = 'word/document.xml'").where(F.col("target").rlike("^(https?|mailto):")).select("path", F.col("target").alias("url"))


def sheet_rows(parts: DataFrame) -> DataFrame:
    """path, sheet, row_no, cells of every row that isn't empty. Rows and cells stand where their references say (row_no from 0, missing cells are empty);
    shared strings are looked up by their number."""
    shared = parts.where("entry = 'xl/sharedStrings.xml'").select("path", F.posexplode(F.regexp_extract_all("xml", F.lit(r"(?s)<si>(.*?)</si>"), F.lit(1))).alias("n", "si"))
    shared = shared.select("path", "n", runs("si", "t").alias("string"))
    sheets = parts.where(F.col("entry").rlike(r"^xl/worksheets/sheet\d+\.xml$"))
    rows = sheets.select("path", F.regexp_extract("entry", r"sheet(\d+)\.xml$", 1).cast("int").alias("sheet"), F.posexplode(every("xml", "row")).alias("place", "r"))
    number = F.nullif(F.regexp_extract("r", r'^<row[^>]*\sr="(\d+)"', 1), F.lit("")).cast("int") - 1
    cell = r"(?s)<c(?:\s(?:[^>/]|/(?!>))*)?(?:/>|>.*?</c>)"
    cells = rows.select("path", "sheet", F.coalesce(number, "place").alias("row_no"), F.posexplode(F.regexp_extract_all("r", F.lit(cell), F.lit(0))).alias("pos", "c"))
    letters = F.regexp_extract("c", r'^<c[^>]*\sr="([A-Z]+)\d+"', 1)
    column = F.aggregate(F.filter(F.split(letters, ""), lambda x: x != ""), F.lit(0), lambda acc, x: acc * 26 + F.ascii(x) - 64)
    value = F.coalesce(F.nullif(F.regexp_extract("c", r"(?s)<v>(.*?)</v>", 1), F.lit("")), F.regexp_extract("c", r"(?s)<t(?:\s[^>]*)?>(.*?)</t>", 1))
    cells = cells.select("path", "sheet", "row_no", F.when(column > 0, column).otherwise(F.col("pos") + 1).alias("pos"), decoded(value).alias("v"), F.col("c").rlike(r'^<c[^>]*\st="s"').alias("is_shared"))
    named = cells.join(shared, (cells["path"] == shared["path"]) & F.col("is_shared") & (F.col("v") == F.col("n").cast("string")), "left").select(cells["path"], "sheet", "row_no", "pos", F.coalesce("string", "v").alias("v"))
    placed = named.groupBy("path", "sheet", "row_no", "pos").agg(F.max("v").alias("v")).groupBy("path", "sheet", "row_no").agg(F.map_from_entries(F.collect_list(F.struct("pos", "v"))).alias("m"), F.max("pos").alias("most"))
    out = placed.select("path", "sheet", "row_no", F.transform(F.sequence(F.lit(1), F.col("most")), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(""))).alias("cells"))
    return out.where(F.exists("cells", lambda c: F.trim(c) != ""))


def integrity(parts: DataFrame) -> DataFrame:
    """Per deck: slides, shapes and status (empty for a file of no bytes or without slides, corrupt, no_shapes or valid)."""
    s = parts.withColumn("is_slide", F.coalesce(F.col("entry").rlike(r"^ppt/slides/slide\d+\.xml$"), F.lit(False)))
    g = s.groupBy("path").agg(F.max("error").alias("error"), F.count_if("is_slide").alias("slides"), F.sum(F.when(F.col("is_slide"), F.regexp_count("xml", F.lit("<p:sp>|<p:sp |<p:pic>|<p:graphicFrame>"))).otherwise(0)).alias("shapes"))
    return g.select("path", "slides", "shapes", F.when(F.col("error").isNotNull(), "corrupt").when(F.col("slides") == 0, "empty").when(F.col("shapes") == 0, "no_shapes").otherwise("valid").alias("status"), "error")


def integrity_totals(checked: DataFrame) -> DataFrame:
    """Files by status."""
    return checked.groupBy("status").agg(F.count("*").alias("files"))


def text_of(rows: DataFrame, path: str, order: list[str], text: str) -> DataFrame:
    """One text for each file, its rows in order; used to compare conversions."""
    w = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("__t"))))
    return rows.groupBy(path).agg(F.array_join(F.transform(w, lambda x: x["__t"]), "\n").alias("text"))

