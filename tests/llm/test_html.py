"""Main text of pages, against a plain reading of the test pages and pages made by hand."""

import re
import time
from html import unescape

import pytest
from brute import SMALL

from tempera.llm import html
from tempera.llm import queries as registered

LONG = "A sentence with commas, clauses, and enough words to count as a paragraph of its own."


def plain(page):
    """For pages with one article of plain paragraphs."""
    article = page.split("<article>")[1].split("</article>")[0]
    lines = re.sub("<[^>]*>", " ", re.sub("</?(?:p|h1)>", "\n", article)).split("\n")
    return "\n".join(" ".join(unescape(line).split()) for line in lines if unescape(line).strip())


def test_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = registered.op13_html(spark, SMALL).collect()
    assert len(rows) == len(pages) and rows[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, plain(pages[r.page_id].html), len(r.text))


def test_odd_rows(spark):
    rows = [(1, None, "u", 1), (1, None, "u", 1), (None, "", None, 2), (3, "<p>a", "u", 3), (4, "no tag &lt;", "u", 4)]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, text string, `row` int")
    found = [(r["row"].page_id, r["row"].text, r["row"]["row"], r["text"]) for r in html.extract(pages).collect()]
    want = [(1, "u", 1, ""), (1, "u", 1, ""), (None, None, 2, ""), (3, "u", 3, "a"), (4, "u", 4, "no tag <")]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert html.extract(pages.limit(0)).count() == 0


AROUND = [
    '<nav><a href="/">Home</a></nav>',
    '<div class="site-header"><p>Welcome, dear reader, to this very long header of the page.</p></div>',
    f'<div id="sidebar"><p>{LONG}</p></div>',
    f'<div class="cookie-notice">{LONG}</div>',
    f'<aside><p>{LONG}</p></aside>',
    f'<div class="ad">{LONG}</div>',
    f'<form><label>Name</label><textarea>{LONG}</textarea><p>{LONG}</p></form>',
    f'<section id="comments"><article class="comment"><p>{LONG * 9}</p></article></section>',
    f'<ol class="commentlist"><li><p>{LONG * 9}</p></li></ol>',
    f'<div role="complementary"><p>{LONG}</p></div>',
    f'<div style="display: none"><p>{LONG}</p></div>',
    f"<script>document.write('<p>{LONG}</p>')</script><style>p {{ color: red }}</style><noscript>{LONG}</noscript>",
    f"<!-- <p>{LONG}</p> -->",
    "<footer>&copy; Someone</footer>",
    '<ul><li><a href="1">One</a></li><li><a href="2">Two</a></li></ul>',
    f"<header><h2>Site</h2><p>{LONG}</p></header>",
]
BODIES = {
    "article": "<article><h1>Title</h1>{}</article>",
    "main": "<main><h1>Title</h1>{}</main>",
    "named": '<div class="wrap has-sidebar"><div class="post-content"><h1>Title</h1>{}</div></div>',
    "plain": "<div><div><h1>Title</h1>{}</div></div>",
    "bare": "<h1>Title</h1>{}",
    "form": "<form id=page><div><h1>Title</h1>{}</div></form>",
}


@pytest.mark.parametrize("body", BODIES)
def test_only_the_article_is_kept(body):
    inner = f"<p>{LONG}</p><p>Short.</p><ul><li>an item</li><li>another</li></ul><p>{LONG}<br>x &amp; y</p><p>End"
    want = "\n".join(["Title", LONG, "Short.", "an item", "another", f"{LONG} x & y", "End"])
    whole = BODIES[body].format(inner)
    for i, junk in enumerate(AROUND):
        if body == "form" and "<form" in junk:
            continue
        for page in (junk + whole, whole + junk if body != "bare" else junk + whole):
            assert html.text_of_page(f"<html><body class='comments-open'>{page}</body></html>") == want, (i, page[:40])


def test_junk_inside_the_article():
    page = "<article><h1 class=page-header>T</h1>" + "".join(f"<p>{i}</p>{j}" for i, j in enumerate(AROUND[:-1])) + "<p>z</p></article>"
    found = html.text_of_page(page).split("\n")
    assert [t for t in found if t not in ("One", "Two")] == ["T", *map(str, range(len(AROUND) - 1)), "z"]


@pytest.mark.parametrize(
    "page,want",
    [
        ("<p>a<p>b</p>c", "a\nb\nc"),
        ("<p>a <b>b<p>c</b> d", "a b\nc d"),
        ("<p>x<b>y</b>z &am<i>p;</i> AT&T &copy 1&nbsp;2 &#8364;&#x41;&notit;</p>", "xyz &amp; AT&T © 1 2 €A¬it;"),
        ("<p>1 < 2 > 0 <3 </p>", "1 < 2 > 0 <3"),
        ('<p title="a>b" class=\'c>d\' data-x=e>f</p>', "f"),
        ("<p>a<!-- > <p>no</p> -->b<!-->c<!DOCTYPE x>d<?php e ?>f</>g</3>h", "abcdfgh"),
        ("<title>no</title><textarea><p>no</textarea><p>yes<script>'</p>'</script>!", "yes!"),
        ("<P>A</P><DIV CLASS=AD>no</DIV><p>foo<span class=ad>no</span>bar", "A\nfoobar"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("<dl><dt>a<dd>b<dt>c</dl><p>x<hr>y<pre> 1\n 2 </pre>", "a\nb\nc\nx\ny\n1 2"),
        ("<p>cut <b off", "cut"),
        ("<script>never closed <p>no", ""),
        ("<p>　a  b\x0bc\r\n</p>", "a b c"),
        ("<h1>a</h2>b", "a\nb"),
    ],
)
def test_markup(page, want):
    assert html.text_of_page(page) == want


@pytest.mark.parametrize(
    "page",
    ["<div>" * 60_000, "<a " * 60_000, '<p title="' * 30_000, "<!--" * 60_000, "<i><div>" + "<b>" * 20_000 + "</i>" * 20_000]
    + ["<p>" * 60_000, "<" * 100_000, "&" * 100_000, "<li>" * 50_000, "<p>x</p>" * 40_000, "<a><div>" * 20_000],
)
def test_work_grows_with_the_length(page):
    start = time.process_time()
    html.text_of_page(page)
    assert time.process_time() - start < 10
