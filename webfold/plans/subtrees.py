"""Templates as repeated structures: menus, and a promotion whose text and length differ from page to page."""

from __future__ import annotations

from pyspark.sql import functions as F

from webfold.operators import templates as TM
from webfold.plans import oracle as O
from webfold.plans.catalog import _pages, register


def promoted_pages(pages):
    """Four of five pages get a promotion with a heading and a list of their own."""
    k = F.col("page_id")
    items = F.array_join(F.transform(F.sequence(F.lit(0), k % 3), lambda i: F.concat(F.lit("<li>deal <b>"), (k * 7 + i).cast("string"), F.lit("</b></li>"))), "")
    promo = F.concat(F.lit("<body><div class='p"), k.cast("string"), F.lit(" promo'><h3>Offer "), k.cast("string"), F.lit("</h3><ul>"), items, F.lit("</ul></div>"))
    return pages.withColumn("html", F.when(k % 5 != 0, F.replace(F.col("html"), F.lit("<body>"), promo)).otherwise(F.col("html")))


def _sql() -> str:
    c = O.parse_url_cols(O.Chain("SELECT page_id, url, html FROM pages"), "url", "_b")
    return c.sql(r"""
, p AS (SELECT _b_host AS host, html LIKE '%<body>%' AND page_id % 5 <> 0 AS promo, regexp_matches(html, '<nav><ul>(<li><a [^>]*>[^<]*</a></li>)+</ul></nav>') AS nav FROM {prev} WHERE _b_ok),
h AS (SELECT host, count(*) AS host_pages, count(*) FILTER (promo) AS promos, count(*) FILTER (nav) AS navs FROM p GROUP BY host)
SELECT host, tag, CAST(n AS INTEGER) AS n_elements, n_pages, host_pages
FROM (SELECT host, 'div' AS tag, 5 AS n, promos AS n_pages, host_pages FROM h UNION ALL SELECT host, 'nav', 4, navs, host_pages FROM h)
WHERE n_pages >= 2 AND n_pages * 100 >= host_pages * 50""").replace("\n\n, p AS", ", p AS").replace("\n, p AS", ", p AS")


register("template_subtrees", _sql())(
    lambda spark, d: TM.template_subtrees(promoted_pages(_pages(spark, d))).select("host", "tag", "n_elements", "n_pages", "host_pages"))
