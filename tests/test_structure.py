"""Main content and Markdown of pages that patterns can't read (own golden snippets), and content dedup."""
import time

import pytest

from webfold.functions.dom import Page, main_content
from webfold.functions.markdown import walk
from webfold.operators.extract import extract_articles
from webfold.operators.pages import content_dedup

CONTENT = [
    ("<body><article><aside>a<aside>b</aside>c</aside>kept</article></body>", "kept"),
    ("<body><article>one</article><p>BUY</p><article>two</article></body>", "<article>one</article><article>two</article>"),
    ("<body><p title='x<article>y'>lead</p><article>real</article></body>", "real"),
    ("<article><p title='a>b'>t</p></article>", "<p title='a&gt;b'>t</p>"),
    ("<article>a<nav>open<p>never closed</article>", "a<nav>open<p>never closed"),
    ("<article>x<script>if (a</b) '</article>'</script>y<style>p>b{}</style></article>", "xy"),
    ("<main><form>f</form>m</main><div>d</div>", "m"),
    ("<body><div><a href=1>home news about</a></div><div><p>Frost bites the beds at night.</p><p>Cover them.</p></div><div class='x gdpr'>Many words on consent here, and more</div></body>",
     "<p>Frost bites the beds at night.</p><p>Cover them.</p>"),
    ("<title>t</title>plain words", "plain words"), ("", ""), (None, ""), ("<p>kept<!-- lost", "<p>kept"), ("a < b <", "a < b <"),
]
MARKDOWN = [
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "- a\n  - b\n- c"),
    ("<ul><li>x<ol><li>y</ol></li><li>z</ul>", "- x\n  1. y\n- z"),
    ("<ol><li><p>p</p><p>q</p></ol>", "1. p\n\n   q"),
    ("<p><a href='e'> </a><a href='?q=1'> here </a><a href='mailto:a@b.c'>m</a>", "[here](https://s.test/a/b?q=1) [m](mailto:a@b.c)"),
    ("<a href='javascript:x()'>run</a> <img src='i.png' alt='pic'><img>", "run ![pic](https://s.test/a/i.png)"),
    ("<p><b>open <i>shut</i></p><p>next</b></p>", "open *shut*\n\nnext"),
    ("<blockquote>a<blockquote>b</blockquote></blockquote>", "> a\n>\n> > b"),
    ("<pre>x\n  ```\n</pre>", "````\nx\n  ```\n````"),
    ("<table><tr><td>1<td>2<tr><td>3<td>4</table>t", "| 1 | 2 |\n| --- | --- |\n| 3 | 4 |\n\nt"),
    ("a&amp;lt;b &#x41;&nbsp;&bogus;", "a&lt;b A &bogus;"),
]


@pytest.mark.parametrize("html,want", CONTENT)
def test_main_content(html, want):
    assert main_content(html) == want


@pytest.mark.parametrize("html,want", MARKDOWN)
def test_markdown(html, want):
    assert walk(html, "https://s.test/a/b") == want


def test_events_are_balanced():
    page = Page("<ul><li><b>x<li>y</ul></i><table><tr><td><p>a<div>b</table>c")
    opened = [e for e in page.events if e is not None and not isinstance(e, str)]
    assert len(opened) == len(page.closing) == sum(e is None for e in page.events)
    assert all(e.parent is None or e.parent.first < e.first <= e.last < e.parent.last for e in opened)


@pytest.mark.parametrize("piece", ["<div>", "<p>", "<a ", "<b>", "</i>", '<a "', "<li>", "<table><tr><td>", "<!", "&", "<aside><p>x", "<script>"])
def test_long_hostile_pages_take_linear_time(piece):
    began = time.time()
    main_content(piece * 40_000)
    walk(piece * 4_000)
    assert time.time() - began < 20


def test_text_of_nested_pages(spark):
    rows = [(1, "https://s.test/x", "<article><aside>a<aside>b</aside>c</aside>one</article>BUY<article>two &amp; <p>three</article>"), (2, None, None)]
    got = extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: (r.text_content, r.word_count) for r in got} == {1: ("one\ntwo &\nthree", 4), 2: ("", 0)}


def test_one_row_a_hash_though_ids_repeat(spark):
    df = spark.createDataFrame([(3, "B"), (5, "A"), (5, "B"), (6, None), (7, None)], "page_id long, content_hash string")
    assert sorted(map(tuple, content_dedup(df).collect()), key=str) == [(3, "B"), (5, "A"), (6, None)]


def test_a_url_is_visited_once(spark):
    from webfold.operators.pages import first_captures
    rows = [(4, "https://s.test/a?utm_source=x"), (2, "https://S.test/a"), (3, "https://s.test/b"), (9, "https://s.test/a#f"), (5, "://"), (6, "://"), (7, None)]
    got = first_captures(spark.createDataFrame([(k, u, "h") for k, u in rows], "page_id long, url string, html string")).collect()
    assert sorted(r.page_id for r in got) == [2, 3, 5, 6, 7]
