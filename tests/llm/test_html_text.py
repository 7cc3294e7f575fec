import html
import random
import re
import time

import numpy as np

from corpusloom.llm.html_text import BAD, GOOD, OPEN, STOP_WORDS, Blocks, main_text, nearest, page_blocks

LONG = "The house that stood on the hill was old and it had been there for as long as any of the people in the town could say."
OTHER = "She went down to the river in the morning and sat with her book by the water until it was too dark to read on."


def text(page):
    return Blocks([page], STOP_WORDS).texts(1)[0]


def article_of(page):
    """The article of a generated page by plain splitting."""
    body = page[page.find("<article>") + 9 : page.rfind("</article>")]
    parts = [" ".join(html.unescape(x.replace("<br>", " ").replace("<b>", "")).split()) for x in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(x for x in parts if x)


def test_all_pages_of_the_corpus(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in main_text(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == article_of(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def test_parts_that_are_not_the_article():
    page = f"""<html><head><title>T</title></head><body class="with-sidebar"><header><h1>Site name</h1></header><nav><a href=x>Home</a></nav>
    <div class="cookie-notice"><p>{OTHER}</p></div><aside>{OTHER}</aside><form><label>Your name</label><input><button>Send</button></form>
    <article class="post comments-open"><header><h1><a href=y>Head &amp; line</a></h1></header><p>{LONG}</p><p>Short.</p><div class="adSlot">{OTHER}</div>
    <ul><li>First&nbsp;point<li>Second</ul><p class="share">Share this now</p><p>Related: <a href=z>{OTHER}</a></p><!-- {OTHER} --><script>if (a<b) "</p>"</script>
    <table><tr><td>One<td>Two</table><p hidden>{OTHER}</p><p>End.</p><article><p>{OTHER}</p></article><section id="comments"><p>{OTHER}</p></section></article>
    <div id="disqus_thread">{OTHER}</div><p>{OTHER}</p><footer>© all of us</footer>"""
    assert text(page).split("\n\n") == ["Head & line", LONG, "Short.", "First point", "Second", "One", "Two", "End."]


def test_pages_without_an_article():
    page = f"<nav><a>A</a></nav><div class=menu><p>{OTHER}</p></div><h1>Title</h1><div>{LONG}</div><div>Yes.</div><div>{OTHER}</div><div><a>{LONG}</a></div><div>Last words</div><div>Copyright of ours, all rights reserved</div>"
    assert text(page).split("\n\n") == ["Title", LONG, "Yes.", OTHER]
    assert text("<div>Some words only</div><footer>x</footer>") == "Some words only"
    assert text("no markup at all") == "no markup at all"
    assert text(f"<main><p>{LONG}</p><article><p>tiny</p></article></main><p>{OTHER}</p>") == f"{LONG}\n\ntiny"


def test_broken_markup():
    assert text(f"<article><p><b>{LONG}<br><p>more &amp;amp; &lt;b&gt; &am &copy</article>") == f"{LONG}\n\nmore &amp; <b> &am ©"
    assert text("<article>a < b and 3<4 <3 <p class='x>y'>q<p title=\"o>n\">z<br><br>w") == "a < b and 3<4 <3\n\nq\n\nz\n\nw"
    assert text("<article>one</div></section>two</article>three") == "one\n\ntwo"
    assert text("<article>seen<p class=\"never closed") == "seen" == text("<article>seen<!-- no end") == text("<article>seen<script>no end") == text("<article>seen</a")
    assert text("<!doctype html><?xml x?><!----><!--><article>x<!-- > -- --!>y</article>") == "xy"
    assert text("") == text("   ") == text("<article></article>") == text(None) == ""


def test_linear_on_hard_pages():
    n = 200_000
    began = time.time()
    for page in ("<" * n, "<a " * n, "<div>" * n, "<li>" * n + "x", "<div class=ad>" * n + "</p>" * n, "<!--" * n, "&" * n, "<p " + "a='" * n, "<b>" * n + "</i>" * n, "<td><tr>" * n, "<p>x" * n):
        text(page)
    assert text("<article>" + "x " * 10**6) == "x " * (10**6 - 1) + "x"
    assert time.time() - began < 90


def test_second_pass_equals_a_search(spark):
    rnd = random.Random(4)
    for _ in range(50):
        page = np.sort(np.array([rnd.randrange(5) for _ in range(40)]))
        values = np.array([rnd.choice([BAD, OPEN, OPEN, OPEN, GOOD]) for _ in page])
        for forward in (False, True):
            got, far = nearest(values, page, forward)
            for i in range(len(page)):
                side = range(i, len(page)) if forward else range(i, -1, -1)
                hit = next((j for j in side if values[j] != OPEN and page[j] == page[i]), None)
                assert got[i] == (OPEN if hit is None else values[hit]) and (hit is None or far[i] == abs(hit - i))


def test_rows_of_any_kind(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "v", f"<article>{LONG}</article>"), (3, "w", "<p>same</p>"), (3, "w", "<p>same</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars", "3 AS block")
    assert sorted(map(tuple, main_text(df).collect()), key=str) == sorted([(1, "u", "", 0), (2, None, "", 0), (None, "v", LONG, len(LONG)), (3, "w", "same", 4), (3, "w", "same", 4)], key=str)
    assert main_text(df.limit(0)).count() == 0
    blocks = page_blocks(df).collect()
    assert [(r.block, r.first, r.label) for r in blocks if r.page_id == 3] == [(0, OPEN, GOOD)] * 2 and len(blocks) == 3
