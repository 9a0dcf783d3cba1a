"""Sitemaps behind an index: children on the www host and relative ones, a foreign child, a circle, and the second root."""

from __future__ import annotations

from pyspark.sql import functions as F

from webfold.operators import sitemaps as SM
from webfold.plans.catalog import _jobs, _pages, _sm_base_sql, register
from webfold.sources import derived as DV

CHUNK = 200  # page ids a child


def sitemap_tree(pages):
    """(doc_url, status, body): an index per domain over children of at most ``CHUNK`` pages each.

    The first root of domains with a name of even length is missing, so that the second is read.
    """
    at = DV.page_hosts(pages).withColumn("chunk", F.floor(F.col("page_id") / CHUNK))
    chunk = F.col("chunk").cast("string")
    name = F.when(F.col("chunk") % 2 == 0, F.concat(F.lit("https://"), "domain", F.lit("/maps/"), chunk, F.lit(".xml"))).otherwise(
        F.concat(F.lit("https://www."), "domain", F.lit("/maps/"), chunk, F.lit(".xml")))
    loc = F.struct("page_id", F.concat(F.lit("<url><loc>\n "), DV._xml_escape(F.col("url")), F.lit(" </loc></url>")).alias("x"))
    lists = at.groupBy("domain", "chunk").agg(F.array_sort(F.collect_list(loc)).alias("l"))  # at most CHUNK rows a group
    children = lists.select(name.alias("doc_url"), F.lit(200).alias("status"), F.concat(F.lit(DV.URLSET), F.array_join("l.x", ""), F.lit("</urlset>")).alias("body"))

    def entry(c):
        return F.concat(F.lit("<sitemap><loc>"), c, F.lit("</loc></sitemap>"))
    child = F.when(F.col("chunk") % 2 == 0, F.concat(F.lit("maps/"), chunk, F.lit(".xml"))).otherwise(name)
    index = lists.groupBy("domain").agg(F.array_sort(F.collect_list(F.struct("chunk", entry(child).alias("x")))).alias("l"))
    even = F.length("domain") % 2 == 0
    own = F.concat(F.lit("https://"), "domain", F.when(even, "/sitemap_index.xml").otherwise("/sitemap.xml"))
    body = F.concat(F.lit("<?xml version='1.0'?><sitemapindex>"), entry(F.lit("https://elsewhere.invalid/x.xml")), F.array_join("l.x", ""), entry(own), F.lit("</sitemapindex>"))
    roots = index.select(own.alias("doc_url"), F.lit(200).alias("status"), body.alias("body"))
    missing = index.filter(even).select(F.concat(F.lit("https://"), "domain", F.lit("/sitemap.xml")), F.lit(404), F.lit(DV.URLSET + "<url><loc>https://x.invalid/</loc></url></urlset>"))
    foreign = index.limit(1).select(F.lit("https://elsewhere.invalid/x.xml"), F.lit(200), F.lit(DV.URLSET + "<url><loc>https://elsewhere.invalid/a</loc></url></urlset>"))
    return children.union(roots).union(missing).union(foreign)


register("sitemap_tree", _sm_base_sql().sql(f"""
, c AS (SELECT domain, page_id, url, dense_rank() OVER (PARTITION BY domain ORDER BY page_id // {CHUNK}) AS child,
          row_number() OVER (PARTITION BY domain, page_id // {CHUNK} ORDER BY page_id) - 1 AS place FROM {{prev}}),
m AS (SELECT domain AS job_id, url AS loc, min([child, place]) AS ord FROM c GROUP BY ALL)
SELECT job_id, loc, array_to_string(ord, '.') AS ord FROM m""").replace("\n\n, c AS", ", c AS").replace("\n, c AS", ", c AS"))(
    lambda spark, d: SM.sitemap_seed_urls(_jobs(spark, d), sitemap_tree(_pages(spark, d))).select("job_id", "loc", F.array_join(F.col("ord"), ".").alias("ord")))
