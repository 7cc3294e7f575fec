"""Web pages as rows: title, language, headings, paragraphs and links, by regular expressions inside Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def visible(html: Column) -> Column:
    """Html without scripts, styles and comments."""
    return F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</(script|style)>", " "), r"(?s)<!--.*?-->", " ")


def untagged(html: Column) -> Column:
    t = F.regexp_replace(html, r"(?s)<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def parse_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, lang, title, headings (level, text) and paragraphs of each page. Null html gives empty parts."""
    h = F.col("h")
    levels = F.transform(F.regexp_extract_all(h, F.lit(r"(?is)<h([1-6])\b[^>]*>.*?</h[1-6]>"), F.lit(1)), lambda x: x.cast("int"))
    heads = F.transform(F.regexp_extract_all(h, F.lit(r"(?is)<h[1-6]\b[^>]*>(.*?)</h[1-6]>"), F.lit(1)), untagged)
    paragraphs = F.transform(F.regexp_extract_all(h, F.lit(r"(?is)<p\b[^>]*>(.*?)</p>"), F.lit(1)), untagged)
    base = pages.select("page_id", "url", visible(F.coalesce("html", F.lit(""))).alias("h"))
    return base.select(
        "page_id", "url", F.lower(F.regexp_extract(h, r'(?i)<html[^>]*\blang="([a-zA-Z-]+)"', 1)).alias("lang"), F.trim(F.regexp_extract(h, r"(?is)<title[^>]*>(.*?)</title>", 1)).alias("title"),
        F.arrays_zip(levels.alias("level"), heads.alias("text")).alias("headings"), paragraphs.alias("paragraphs"),
    )


def page_links(pages: DataFrame) -> DataFrame:
    """One row for each link: page_id, pos (from 0), url."""
    found = F.regexp_extract_all(visible(F.coalesce("html", F.lit(""))), F.lit(r'(?i)<a\b[^>]*?href="([^"]*)"'), F.lit(1))
    return pages.select("page_id", F.posexplode(found).alias("pos", "url"))


def page_paragraphs(pages: DataFrame) -> DataFrame:
    """Paragraph atoms: page_id, location (p:number), content."""
    return parse_pages(pages).select("page_id", F.posexplode("paragraphs").alias("i", "content")).where("content <> ''").select("page_id", F.concat(F.lit("p:"), F.col("i") + 1).alias("location"), "content")
