"""Queries on pages whose structure patterns can't read: nested chrome, sibling articles, nested lists.

The corpus has one plain article a page, so the input puts each page's own article into a harder page.  The SQL
takes the same article apart on its own and says what must come out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webfold.operators import extract as E
from webfold.operators import pages as P
from webfold.plans.catalog import _pages, register
from webfold.plans.oracle import q


def nested_pages(pages: DataFrame) -> DataFrame:
    """Each page with a banner, asides in asides, ``>`` in attributes, an advert between two articles, and a nested article."""
    opening = ("<div class='cookie-consent'>We use <b>cookies</b></div><p title='an <article> of > two'>before</p><article data-x=\"a>b</article>\">"
               "<aside>ad<aside>inner</aside> rest<nav>menu</nav> of it</aside>")
    closing = F.concat(F.lit("<form>ask<div>us</div></form></article><p>BUY NOW</p><article><h2>Part "), F.col("page_id").cast("string"),
                       F.lit("</h2><p>one<article><p>within</article><ul><li>two<li>three</ul><footer>foot<footer>er</footer></footer></article><p>after"))
    return pages.withColumn("html", F.replace(F.replace(F.col("html"), F.lit("<article>"), F.lit(opening)), F.lit("</article>"), closing))


_TEXT = ("[x for x in [trim(regexp_replace(regexp_replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&quot;', '\"'), '&amp;', '&'), '\\s+', ' ', 'g'), '^ +| +$', '', 'g')) "
         "for x in string_split_regex(body, '<h1>|</h1>|<p>|</p>|<br>')] if x <> '']")

register("nested_articles", f"""
WITH a AS (SELECT page_id, regexp_extract(html, '<article>(.*)</article>', 1, 's') AS body FROM pages),
b AS (SELECT page_id, array_to_string(list_concat({_TEXT}, ['Part ' || page_id, 'one', 'within', 'two', 'three']), chr(10)) AS text_content FROM a)
SELECT page_id, text_content, CAST(len(regexp_extract_all(text_content, '\\S+')) AS INTEGER) AS word_count FROM b""")(
    lambda spark, d: E.extract_articles(nested_pages(_pages(spark, d))).select("page_id", "text_content", "word_count"))


def structured_pages(pages: DataFrame) -> DataFrame:
    """Each page's heading within lists in lists, a quote, a table, code and links, as an article of its own."""
    head = F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1)
    k = F.col("page_id").cast("string")
    parts = [
        "<html><body><article><h2>", head, "</h2><p>See <a href='/k/", k, "?a=1'>item <b>", k, "</b></a>, <a href='#x'></a><a href='javascript:go()'>go</a> and <em>", k, "<p>on</p>",
        "<ul><li>first<ul><li>inner ", k, "<ol><li>deep<li>deeper</ol></li><li>inner too</ul></li><li>second</ul>",
        "<blockquote><p>said ", k, "<p>then<ul><li>in quote</ul></blockquote>",
        "<table><tr><th>id<th>a|b<tr><td>", k, "<td><i>x</i></table><pre><code>if  ", k, ":\n    go()\n</code></pre></article></body></html>"]
    return pages.withColumn("html", F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))


_WANTED = [
    "## {head}", "", "See [item **{k}**]({site}/k/{k}?a=1), go and {k}", "", "on", "",
    "- first", "  - inner {k}", "    1. deep", "    1. deeper", "  - inner too", "- second", "",
    "> said {k}", ">", "> then", ">", "> - in quote", "",
    "| id | a\\|b |", "| --- | --- |", "| {k} | *x* |", "", "```", "if  {k}:", "    go()", "```"]


def _wanted_sql() -> str:
    text = q("\n".join(_WANTED))
    return f"replace(replace(replace({text}, '{{head}}', head), '{{site}}', site), '{{k}}', CAST(page_id AS VARCHAR))"


register("markdown_structures", f"""
WITH a AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]+') AS site,
             trim(regexp_replace(replace(replace(regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'), '<[^>]*>', '', 'g'), '&quot;', '"'), '&amp;', '&'), '\\s+', ' ', 'g')) AS head FROM pages)
SELECT page_id, {_wanted_sql()} AS markdown FROM a""")(
    lambda spark, d: P.to_markdown(E.extract_articles(structured_pages(_pages(spark, d)))).select("page_id", "markdown"))
