"""Text expressions over whole columns: normal forms, fingerprints, similarity, links. All are built-in Spark functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns of video links, in the order in which they are tried.
VIDEO_LINKS = (r"(?:https?://)?(?:www\.)?youtube\.com/watch\?v=[\w-]+", r"(?:https?://)?youtu\.be/[\w-]+", r"(?:https?://)?(?:www\.)?vimeo\.com/\d+")
#: What a file name's normal form loses, in this order: copy marks, separators, the extension.
COPY_MARK, SEPARATORS, EXTENSION = r"\s*\(\d+\)\s*", r"[_\-\s]+", r"\.\w+$"
URL = r"https?://[^\s<>\"')\]]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value worked out once a row; an expression that is named inside a lambda, or by one that the optimizer copies, is worked out each time."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def norm(text: Column) -> Column:
    """Lower case, runs of Unicode white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)\s+", " "))


def norm_start(text: Column, cut: int) -> Column:
    """The first characters of the normal form, from the text's beginning where that has enough of them; the lower case of a capital sigma depends on what follows, so texts that begin with one are taken whole."""
    begins = F.substring(text, 1, 5 * cut)
    return let(norm(begins), lambda n: F.when((F.length(n) > cut) & ~F.contains(begins, F.lit("\u03a3")), F.substring(n, 1, cut)).otherwise(F.substring(norm(text), 1, cut)))


def fingerprint(text: Column) -> Column:
    return F.sha2(norm(text), 256)


def is_trivial(text: Column, least: int = 5) -> Column:
    return F.length(norm(text)) < least


def is_label(text: Column, words: list[str], pattern: str) -> Column:
    """A structural label: one of the words within 30 characters, or the pattern within 60."""
    return let(norm(text), lambda n: ((F.length(n) <= 30) & n.isin(words)) | ((F.length(n) <= 60) & n.rlike(pattern)))


def name_form(name: Column) -> Column:
    """A file name without copy marks and extension, separators as spaces, lower case; in this order."""
    bare = F.regexp_replace(name, COPY_MARK, "")
    bare = F.lower(F.trim(F.regexp_replace(bare, SEPARATORS, " ")))
    return F.regexp_replace(bare, EXTENSION, "")


def edit_ratio(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; 0 if either is empty."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0)).otherwise(1 - F.levenshtein(a, b) / longest)


def word_set(text: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(norm(text), " "), ""))


def containment(part: Column, whole: Column) -> Column:
    """Share of the different words of part that whole has too; 1 for a part without words."""
    a, b = word_set(part), word_set(whole)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


def is_video(url: Column) -> Column:
    return url.rlike("(?i)" + "|".join(VIDEO_LINKS))


def urls(text: Column) -> Column:
    """All links of a text, closing punctuation cut, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(URL), F.lit(0)), lambda u: F.rtrim(u, F.lit(".,;:")))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def capped(text: Column, most: int, mark: str = "...") -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit(mark))).otherwise(text)


def punctuated(text: Column) -> Column:
    """The text with a full stop unless it ends in punctuation; empty texts stay."""
    t = F.trim(text)
    return F.when((t == "") | t.rlike('[.!?:)\\]"”]$'), t).otherwise(F.concat(t, F.lit(".")))


def near_word(text: Column, word: str, context: str, reach: int = 80) -> Column:
    """Whether word occurs within reach characters of context."""
    return text.rlike(rf"(?is)\b{word}\b.{{0,{reach}}}(?:{context})|(?:{context}).{{0,{reach}}}\b{word}\b")


def tagged(text: Column, tags: dict[str, str]) -> Column:
    """Sorted canonical tags whose key words occur in the text, on word boundaries."""
    each = [F.when(text.rlike(rf"(?i)\b{k}\b"), F.lit(v)) for k, v in tags.items()]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*each)))) if each else F.array().cast("array<string>")
