"""Canonical links that lead through several pages, or in a circle."""

from __future__ import annotations

from pyspark.sql import functions as F

from webfold.functions.urls import normalize_urls
from webfold.operators import extract as E
from webfold.operators import quality as QA
from webfold.plans import oracle as O
from webfold.plans.catalog import _pages, register


def linked_pages(pages):
    """Each page declares a canonical link: page p to p - 1 within fours, every third four closes a circle of three."""
    p = F.col("page_id")
    to = F.when(p % 4 != 0, p - 1).when(p % 12 == 0, p + 2)
    urls = pages.select(F.col("page_id").alias("_to"), F.regexp_replace("url", "&", "&amp;").alias("_url"))
    tag = F.concat(F.lit('<link href="'), F.col("_url"), F.lit('" rel="canonical"></head>'))
    linked = pages.withColumn("_to", to).join(urls, "_to", "left")
    return linked.withColumn("html", F.when(F.col("_url").isNull(), F.col("html")).otherwise(F.replace("html", F.lit("</head>"), tag))).drop("_to", "_url")


def _sql() -> str:
    c = O.normalize_cols(O.Chain("SELECT page_id, url FROM pages"), "url", "norm")
    norm = c.sql("SELECT page_id, norm FROM {prev}")
    return f"""
WITH RECURSIVE n AS MATERIALIZED ({norm}),
p AS (SELECT a.page_id, a.norm, coalesce(b.norm, a.norm) AS nxt FROM n a
      LEFT JOIN n b ON b.page_id = CASE WHEN a.page_id % 4 <> 0 THEN a.page_id - 1 WHEN a.page_id % 12 = 0 THEN a.page_id + 2 END WHERE a.norm IS NOT NULL),
h AS MATERIALIZED (SELECT norm AS u, arg_min(nxt, page_id) AS v FROM p GROUP BY norm HAVING u <> v),
walk AS (SELECT page_id, norm, nxt, [nxt] AS seen FROM p
         UNION ALL SELECT page_id, norm, v, list_append(seen, v) FROM walk JOIN h ON h.u = nxt WHERE NOT list_contains(seen, v)),
last AS (SELECT page_id, norm, arg_max(seen, len(seen)) AS seen FROM walk GROUP BY ALL),
ends AS (SELECT page_id, norm, CASE WHEN v IS NULL THEN seen[-1] ELSE list_min(seen[list_position(seen, v):]) END AS identity_url
         FROM last LEFT JOIN h ON h.u = seen[-1])
SELECT page_id, norm AS norm_url, identity_url, count(*) OVER (PARTITION BY identity_url) AS n_aliases FROM ends"""


register("canonical_chains", _sql())(
    lambda spark, d: QA.canonical_identity(E.extract_articles(linked_pages(_pages(spark, d)))).select("page_id", "norm_url", "identity_url", "n_aliases"))
