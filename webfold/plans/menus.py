"""Menus refused, articles kept: the Markdown of each page's navigation and of its article (E5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from webfold.operators import navigation as N
from webfold.operators import pages as P
from webfold.plans.catalog import _pages, register
from webfold.plans.oracle import q


def parts(pages):
    """(page_id, part, norm_url, content_html): the menu and the article of each page."""
    whole = F.array(*[F.struct(F.lit(part).alias("part"), F.regexp_extract("html", rf"(?s)<{tag}>(.*?)</{tag}>", 1).alias("content_html"))
                      for part, tag in (("menu", "nav"), ("article", "article"))])
    return pages.select("page_id", F.col("url").alias("norm_url"), F.inline(whole))


_WORDS = r"len(regexp_extract_all({}, '\S+'))"

register("navigation_like", rf"""
WITH a AS (SELECT page_id, regexp_extract(html, '<nav>(.*?)</nav>', 1, 's') AS menu, regexp_extract(html, '<article>(.*?)</article>', 1, 's') AS body FROM pages),
menu AS (SELECT page_id, unnest(regexp_extract_all(menu, '<a [^>]*>([^<]*)</a>', 1)) AS line FROM a),
body AS (SELECT page_id, unnest(string_split_regex(body, '<h1>.*?</h1>|<p>|</p>|<br>')) AS line FROM a),
text AS (SELECT page_id, trim(regexp_replace(replace(replace(regexp_replace(line, '<[^>]*>', '', 'g'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS line FROM body),
kinds AS (SELECT page_id, 'menu' AS part, 'n' AS kind, {_WORDS.format('line')} AS words FROM menu
  UNION ALL
  SELECT page_id, 'article', CASE WHEN {_WORDS.format('line')} < 4 AND NOT regexp_matches(line, {q(N.SENTENCE_END)}) THEN 'n' ELSE 'p' END, {_WORDS.format('line')}
  FROM text WHERE line <> ''),
sums AS (SELECT page_id, part, count(*) FILTER (kind = 'n') AS n_nav_lines, coalesce(sum(words) FILTER (kind = 'n'), 0) AS nav_words,
                coalesce(sum(words) FILTER (kind = 'p'), 0) AS prose_words FROM kinds GROUP BY ALL)
SELECT page_id, part, CAST(coalesce(n_nav_lines, 0) AS INTEGER) AS n_nav_lines, CAST(coalesce(nav_words, 0) AS INTEGER) AS nav_words,
       CAST(coalesce(prose_words, 0) AS INTEGER) AS prose_words,
       coalesce(prose_words, 0) < 10 OR prose_words * 100 < (prose_words + nav_words) * 50 AS is_navigation
FROM (SELECT page_id, unnest(['menu', 'article']) AS part FROM pages) LEFT JOIN sums USING (page_id, part)""")(
    lambda spark, d: N.navigation_like(P.to_markdown(parts(_pages(spark, d)))).select(
        "page_id", "part", "n_nav_lines", "nav_words", "prose_words", "is_navigation"))
