"""Operator 13. Main text of web pages by two passes of block rules.

A page is cut into blocks of text at its block elements. What the markup says about a block is its zone: inside an article or main
element, inside a menu, page header, footer, sidebar, notice, advert, form or reader comments (by element, role or class name), or neither.

First pass, each block alone: structural boilerplate and blocks made mostly of links are bad; long blocks with enough stop words are good, and in
an article any block with a stop word or some length is; the others are open. Second pass: an open block takes the label of the nearest
decided block of its page, of two at the same distance a good one; a heading looks only at what follows it. In a page with an article, what lies outside it is
bad except headings, and the article's open blocks look at blocks of the article only. If a page has no good block at all, its open ones are its text.
Blocks of a whole slice of pages are labelled at once in arrays.

Defined results: null and empty pages, and pages without text, give the empty text; an empty table gives no rows; equal rows have equal
results; extra columns are ignored; broken markup is taken as browsers do where cheap: a tag, comment or script that never ends swallows the rest.
Character references are decoded once. Pages are parsed whole, in time linear in their length.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pieces

#: Stop words of the four languages of the corpus; a parameter of the operator.
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he in is it not of on or she that the their they this to was were which with "
    "aber als auch auf aus bei das dem den der des die ein eine einen er es für im ist mit nicht sich sie sind und von war wie zu "
    "au aux avec ce ces dans de des du elle en est et il la le les mais ne ou par pas plus pour que qui se sont sur un une "
    "al como con del el era ella ese esta este fue la las lo los más no o para pero por que se sin su sus un una y".split()
)

# Element and attribute names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title iframe noembed noframes xmp".split())
UNSHOWN = frozenset("template svg math object select datalist button canvas audio video map applet".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form header hgroup hr html legend li "
    "main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: An element that starts closes an open one of its kind unless one of these lists or tables opened in between.
CLOSES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr")}
BAD_ELEMENTS = frozenset("nav footer aside form dialog menu search".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words in class names and ids that mark boilerplate, unless another word of the same name takes it back.
BAD_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot alert alerts announcement banner breadcrumb breadcrumbs consent cookie cookies copyright disclaimer footer gdpr login masthead menu modal "
    "nav navbar navigation newsletter notice notices notification overlay pager paywall pagination popup promo promoted promotion recommended recommendations related search share "
    "sharing sidebar signup social sponsor sponsored subscribe toolbar topbar".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist disqus replies reply respond responses discussion".split())
TAKEN_BACK = frozenset("with has no without not free off disabled closed open".split())

TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[\s/=]++|[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']?[^\s>]*+))?+)*+)>""")
ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']?[^\s>]*+)))?+""")
COMMENT = re.compile(r"<!--(?:-?>|.*?--!?>)", re.S)
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
LETTERS = re.compile(r"[^\W\d_]+")
RIGHTS = re.compile(r"©|\ball rights reserved\b", re.I)

#: Zones. Unshown text isn't a block; FIRM boilerplate holds no article.
UNSEEN, FIRM, BOILERPLATE, PLAIN, MAIN, ARTICLE = -3, -2, -1, 0, 1, 2
BAD, OPEN, GOOD = -1, 0, 1
LINKED, LONG, SHORT, DENSE = 0.5, 15, 4, 0.12


def zone_of(name: str, attributes: str, zone: int) -> int:
    """The zone inside an element that starts in a zone."""
    if zone == UNSEEN or name in UNSHOWN:
        return UNSEEN
    values = {a.lower(): b or c or d for a, b, c, d in ATTRIBUTE.findall(attributes)} if attributes.strip(" /") else {}
    if "hidden" in values or values.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", values.get("style", ""), re.I):
        return UNSEEN
    names = [{w.lower() for w in NAME_WORDS.findall(n)} for n in f"{values.get('class', '')} {values.get('id', '')}".split()] if name not in ("html", "body", "main") else []
    names = [n for n in names if not n & TAKEN_BACK]
    role = values.get("role", "").lower()
    if zone == FIRM or any(n & COMMENT_NAMES for n in names) or name == "article" and zone == ARTICLE or name in ("nav", "aside", "footer"):
        return FIRM  # an article inside an article is a reader's comment, by the definition of the element
    if name == "article":
        return ARTICLE
    if name == "main" or role == "main":
        return max(zone, MAIN)
    heads = zone < MAIN and (name == "header" or any("header" in n for n in names))
    if name in BAD_ELEMENTS or role in BAD_ROLES or heads or any(n & BAD_NAMES for n in names):
        return min(zone, BOILERPLATE)
    return zone


def page_parts(page: str):
    """Blocks of a page in order: (text, characters in links, zone, whether a heading)."""
    stack: list[tuple[str, int]] = []
    places: dict[str, list[int]] = defaultdict(list)
    zone, linked, link, breaks, heading, parts, at = PLAIN, 0, False, 0, False, [], 0

    def close(place: int) -> int:
        while len(stack) > place:
            places[stack.pop()[0]].pop()
        return stack[-1][1] if stack else PLAIN

    def block():
        nonlocal parts, linked, breaks
        text = " ".join("".join(parts).split()) if parts else ""
        out = (text, linked, zone, heading) if text and zone != UNSEEN else None
        parts, linked, breaks = [], 0, 0
        return out

    def take(text: str) -> None:
        nonlocal linked, breaks
        if zone == UNSEEN or not text:
            return
        if "&" in text:
            text = entities.unescape(text)
        parts.append(text)
        if not text.isspace():
            breaks = 0
            linked += sum(map(len, text.split())) if link else 0

    while True:
        lt = page.find("<", at)
        if lt < 0:
            take(page[at:])
            break
        take(page[at:lt])
        after = page[lt + 1 : lt + 3]
        if not (after[:1].isalpha() and after[:1].isascii() or after[:1] in ("/", "!", "?") and after[:1]):
            take("<")
            at = lt + 1
            continue
        if after[:1] in "!?" or after[:1] == "/" and not (after[1:].isalpha() and after[1:].isascii()):
            gone = COMMENT.match(page, lt) if page.startswith("<!--", lt) else None
            at = gone.end() if gone else 0 if page.startswith("<!--", lt) else page.find(">", lt) + 1
            if not at:
                break
            continue
        tag = TAG.match(page, lt)
        if tag is None:
            break
        at, (ends, name, attributes) = tag.end(), tag.groups()
        name = name.lower()
        if name == "br":
            breaks += 1
            parts.append(" ")
            if breaks > 1 and (out := block()):
                yield out
            continue
        if name in BLOCKS:
            if out := block():
                yield out
            heading = name in HEADINGS and not ends
        if ends:
            if name == "a":
                link = False
            if (open_ := places[name]) and (name in ("article", "main") or open_[-1] > max([-1, *places["article"][-1:], *places["main"][-1:]])):
                zone = close(open_[-1])
            continue
        if name in RAW:
            end = RAW_END[name].search(page, at)
            if end is None:
                break
            at = end.start()
            continue
        if name in VOID or name in ("svg", "math") and attributes.endswith("/"):
            continue
        if name == "a":
            link = True
        elif name in BLOCKS:
            if places["p"]:
                zone = close(places["p"][-1])
            kinds = ("td", "th") if name in ("td", "th") else ("dt", "dd") if name in ("dt", "dd") else (name,)
            if name in CLOSES:
                last = max([-1, *[i for k in kinds for i in places[k][-1:]]])
                if last > max([-1, *[i for k in CLOSES[name] for i in places[k][-1:]]]):
                    zone = close(last)
        inner = zone_of(name, attributes, zone)
        if name in BLOCKS or inner != zone or places[name]:
            if inner != zone and (out := block()):
                yield out
            places[name].append(len(stack))
            stack.append((name, inner))
            zone = inner
    if out := block():
        yield out


def nearest(values: np.ndarray, page: np.ndarray, forward: bool) -> tuple[np.ndarray, np.ndarray]:
    """Per block the label and the distance of the nearest decided block of its page before it, or from it on; 0 and a large distance where none is."""
    at, n = np.arange(len(values)), len(values)
    if forward:
        found = np.minimum.accumulate(np.where(values != OPEN, at, n)[::-1])[::-1]
    else:
        found = np.maximum.accumulate(np.where(values != OPEN, at, -1))
    ok = (found >= 0) & (found < n)
    found = np.where(ok, found, 0)
    ok &= page[found] == page
    return np.where(ok, values[found], OPEN), np.where(ok, np.abs(found - at), n + 1)


def labels(page: np.ndarray, zone: np.ndarray, heading: np.ndarray, chars: np.ndarray, linked: np.ndarray, words: np.ndarray, stops: np.ndarray, rights: np.ndarray):
    """Labels of all blocks after the first pass and after the second. page: ascending page numbers of the blocks."""
    if not len(page):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = lambda mask: np.bincount(page, np.where(mask, chars, 0), page[-1] + 1)[page]
    least = np.where(2 * size(zone == ARTICLE) >= size(zone >= MAIN), ARTICLE, MAIN)  # the zone that holds the page's main part
    zoned = size(zone >= MAIN) > 0
    inside = zoned & (zone >= least)
    rich = stops >= DENSE * words
    first = np.where((words >= LONG) & rich, GOOD, OPEN)
    first = np.where(inside & ((stops > 0) | (words >= SHORT)), GOOD, first)
    first = np.where(zoned & ~inside, np.where(heading, OPEN, BAD), first)
    links = (linked > LINKED * chars) & ~(heading & (inside | ~zoned))
    first = np.where((zone < PLAIN) | links | rights & ~inside, BAD, first)
    seen = np.where(zoned & ~inside & ~heading, BAD, first)
    outer = np.where(inside & (first == BAD), OPEN, seen)  # an article's open blocks look past link lists inside it
    (before, far), (after, near) = nearest(outer, page, False), nearest(outer, page, True)
    best = np.where((near < far) | (near == far) & (after == GOOD) | heading & (after != OPEN), after, before)
    best = np.where(inside, GOOD, best)
    no_good = ~(np.bincount(page, first == GOOD, page[-1] + 1)[page] > 0)
    best = np.where(no_good | (best == OPEN), GOOD, best)
    return first, np.where(first == OPEN, best, first)


class Blocks:
    """Blocks of a slice of pages with their features and labels."""

    def __init__(self, pages: list[str | None], stop_words: frozenset[str]):
        rows = [(i, *part) for i, page in enumerate(pages) if page for part in page_parts(page)]
        self.text = [r[1] for r in rows]
        column = lambda k: np.array([r[k] for r in rows], np.int64)
        self.page, self.linked, self.zone, self.heading = column(0), column(2), column(3), column(4).astype(bool)
        letters = [LETTERS.findall(t.lower()) for t in self.text]
        self.words = np.array([t.count(" ") + 1 for t in self.text], np.int64)
        self.stops = np.array([sum(w in stop_words for w in x) for x in letters], np.int64)
        self.chars = np.array([len(t) - t.count(" ") for t in self.text], np.int64)
        rights = np.array([bool(RIGHTS.search(t)) for t in self.text], bool)
        self.first, self.label = labels(self.page, self.zone, self.heading, self.chars, self.linked, self.words, self.stops, rights)

    def texts(self, n: int) -> list[str]:
        """Per page its good blocks, two line ends between them."""
        out: list[list[str]] = [[] for _ in range(n)]
        for i in np.flatnonzero(self.label == GOOD).tolist():
            out[self.page[i]].append(self.text[i])
        return ["\n\n".join(x) for x in out]


def main_text(pages_table: DataFrame, stop_words: frozenset[str] = STOP_WORDS) -> DataFrame:
    """Per page: page_id, url, text and n_chars."""

    def run(batches):
        for whole in batches:
            for batch in pieces(whole, "html"):
                texts = Blocks(batch.column("html").to_pylist(), stop_words).texts(batch.num_rows)
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kept = pages_table.select("page_id", "url", "html")
    return kept.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in kept.dtypes[:2]) + ", text string, n_chars long")


def page_blocks(pages_table: DataFrame, stop_words: frozenset[str] = STOP_WORDS) -> DataFrame:
    """A row per block: page_id, block (its place in the page), text, zone, heading, chars, linked, words, stops, and the labels of both passes (-1 bad, 0 open, 1 good)."""

    def run(batches):
        for whole in batches:
            for batch in pieces(whole, "html"):
                b = Blocks(batch.column("html").to_pylist(), stop_words)
                place = np.arange(len(b.page)) - np.searchsorted(b.page, b.page)
                columns = [batch.column("page_id").take(pa.array(b.page)), place, pa.array(b.text, pa.string()), b.zone, b.heading, b.chars, b.linked, b.words, b.stops, b.first, b.label]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=["page_id", "block", "text", "zone", "heading", "chars", "linked", "words", "stops", "first", "label"])

    kept = pages_table.select("page_id", "html")
    return kept.mapInArrow(run, f"page_id {kept.dtypes[0][1]}, block long, text string, zone long, heading boolean, chars long, linked long, words long, stops long, first long, label long")
