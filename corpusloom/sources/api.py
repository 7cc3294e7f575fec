"""Documents that come as nested JSON from an editor's API, flattened by explode; schemas are declared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUNS = "textElements:array<struct<textRun:struct<content:string,style:struct<link:struct<url:string>>>>>"
DECK = f"presentationId string, title string, slides array<struct<objectId:string,pageElements:array<struct<objectId:string,shape:struct<text:struct<{RUNS}>>,table:struct<tableRows:array<struct<tableCells:array<struct<text:struct<{RUNS}>>>>>>,image:struct<contentUrl:string>,video:struct<url:string,source:string,id:string>>>,slideProperties:struct<notesPage:struct<pageElements:array<struct<shape:struct<text:struct<{RUNS}>>>>>>>>"
PARAGRAPH = "paragraph:struct<paragraphStyle:struct<namedStyleType:string>,elements:array<struct<textRun:struct<content:string,textStyle:struct<link:struct<url:string>>>>>>"
DOC = f"documentId string, title string, body struct<content:array<struct<{PARAGRAPH},table:struct<tableRows:array<struct<tableCells:array<struct<content:array<struct<{PARAGRAPH}>>>>>>>>>>"


def _trimmed(text):
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _slides(decks: DataFrame) -> DataFrame:
    return decks.select("presentationId", F.posexplode("slides").alias("i", "s")).select("presentationId", (F.col("i") + 1).alias("slide"), F.posexplode("s.pageElements").alias("pos", "e"))


def _joined(runs):
    return _trimmed(F.array_join(F.transform(runs, lambda r: F.coalesce(r["textRun"]["content"], F.lit(""))), ""))


def deck_texts(decks: DataFrame) -> DataFrame:
    """presentationId, slide, pos, text of the shapes with text."""
    return _slides(decks).select("presentationId", "slide", "pos", _joined(F.col("e.shape.text.textElements")).alias("text")).where("text <> ''")


def deck_links(decks: DataFrame) -> DataFrame:
    """Links of shapes and of table cells."""
    none = F.array().cast("array<struct<textRun:struct<content:string,style:struct<link:struct<url:string>>>>>")
    cells = F.flatten(F.flatten(F.transform("e.table.tableRows", lambda r: F.transform(r["tableCells"], lambda c: F.coalesce(c["text"]["textElements"], none)))))
    runs = F.concat(F.coalesce("e.shape.text.textElements", none), F.coalesce(cells, none))
    each = _slides(decks).select("presentationId", "slide", F.explode(runs).alias("r"))
    return each.select("presentationId", "slide", F.col("r.textRun.style.link.url").alias("url"), _trimmed(F.col("r.textRun.content")).alias("text")).where("url is not null")


def deck_videos(decks: DataFrame) -> DataFrame:
    return _slides(decks).where("e.video is not null").select("presentationId", "slide", "e.video.url", "e.video.source", F.col("e.video.id").alias("video_id"))


def deck_tables(decks: DataFrame) -> DataFrame:
    """presentationId, slide, pos, headers, rows; the first row of a table is its header."""
    rows = F.transform("e.table.tableRows", lambda r: F.transform(r["tableCells"], lambda c: F.coalesce(_joined(c["text"]["textElements"]), F.lit(""))))
    t = _slides(decks).where("e.table is not null").select("presentationId", "slide", "pos", rows.alias("r"))
    return t.select("presentationId", "slide", "pos", F.try_element_at("r", F.lit(1)).alias("headers"), F.slice("r", F.lit(2), F.greatest(F.size("r") - 1, F.lit(0))).alias("rows"))


def deck_notes(decks: DataFrame) -> DataFrame:
    """presentationId, slide, notes of the slides whose notes page has text."""
    each = decks.select("presentationId", F.posexplode("slides").alias("i", "s")).select("presentationId", (F.col("i") + 1).alias("slide"), F.col("s.slideProperties.notesPage.pageElements").alias("e"))
    text = F.array_join(F.filter(F.transform("e", lambda e: _joined(e["shape"]["text"]["textElements"])), lambda t: t != ""), "\n")
    return each.select("presentationId", "slide", text.alias("notes")).where("notes <> ''")


def deck_image_urls(decks: DataFrame) -> DataFrame:
    return _slides(decks).where("e.image.contentUrl is not null").select("presentationId", "slide", F.col("e.image.contentUrl").alias("url"))


def doc_blocks(docs: DataFrame) -> DataFrame:
    """documentId, pos, style, text of the paragraphs that aren't empty."""
    each = docs.select("documentId", F.posexplode("body.content").alias("pos", "c")).where("c.paragraph is not null")
    text = _trimmed(F.array_join(F.transform("c.paragraph.elements", lambda e: F.coalesce(e["textRun"]["content"], F.lit(""))), ""))
    return each.select("documentId", "pos", F.col("c.paragraph.paragraphStyle.namedStyleType").alias("style"), text.alias("text")).where("text <> ''")


def doc_tables(docs: DataFrame) -> DataFrame:
    """documentId, pos, headers (the first row) and rows of the tables of documents."""
    run = lambda e: F.coalesce(e["textRun"]["content"], F.lit(""))
    para = lambda p: F.array_join(F.transform(F.coalesce(p["paragraph"]["elements"], F.array().cast("array<struct<textRun:struct<content:string,textStyle:struct<link:struct<url:string>>>>>")), run), "")
    cell = lambda c: _trimmed(F.array_join(F.transform(c["content"], para), ""))
    each = docs.select("documentId", F.posexplode("body.content").alias("pos", "c")).where("c.table is not null")
    rows = each.select("documentId", "pos", F.transform("c.table.tableRows", lambda r: F.transform(r["tableCells"], cell)).alias("r"))
    return rows.select("documentId", "pos", F.try_element_at("r", F.lit(1)).alias("headers"), F.slice("r", F.lit(2), F.greatest(F.size("r") - 1, F.lit(0))).alias("rows"))


def doc_links(docs: DataFrame) -> DataFrame:
    each = docs.select("documentId", F.explode("body.content").alias("c")).select("documentId", F.explode("c.paragraph.elements").alias("e"))
    return each.select("documentId", F.col("e.textRun.textStyle.link.url").alias("url"), _trimmed(F.col("e.textRun.content")).alias("text")).where("url is not null")
