"""Queries on the crawl frontier: a resumed run, and a budget of one job that owns every URL."""

from __future__ import annotations

from pyspark.sql import functions as F

from webfold.functions.urls import normalize_urls
from webfold.operators import extract as E
from webfold.operators import frontier as FR
from webfold.plans import oracle as O
from webfold.plans.catalog import ORACLE, _captures, _page_graph, _pages, register

RESUME_DEPTH = 5


def _graph_job(spark, max_pages: int, max_depth: int):
    return spark.createDataFrame([("graph", "", [], max_pages, max_depth, "sitemap")],
                                 "job_id string, domain string, allowed_domains array<string>, max_pages int, max_depth int, discovery_mode string")


@register("resumed_frontier", f"SELECT * FROM ({ORACLE['deep_frontier']}) WHERE depth <= {RESUME_DEPTH}")
def q_resumed_frontier(spark, d):
    """A run in which the captures with an error status were missing, resumed when all pages are there."""
    edges, p = _page_graph(spark, d)
    seed = p.filter(F.col("page_id") == 0).select(F.lit("graph").alias("job_id"), F.col("norm").alias("loc"), F.array().cast("array<int>").alias("ord"))
    jobs = _graph_job(spark, 0, RESUME_DEPTH)
    first = normalize_urls(E.capture_gate(_captures(spark, d)).select("url"), "url", "norm").select(F.col("norm").alias("url")).filter("url IS NOT NULL")
    earlier = FR.crawl_frontier(jobs, edges, first, seed, scope=FR.any_host)
    return FR.crawl_frontier(jobs, edges, p.select(F.col("norm").alias("url")), seed, scope=FR.any_host, earlier=earlier).select("url", "depth")


def _budget_sql() -> str:
    c = O.normalize_cols(O.Chain("SELECT page_id, url FROM pages"), "url", "norm")
    c.step("SELECT page_id, norm FROM {prev} WHERE norm IS NOT NULL")
    O.parse_url_cols(c, "norm", "_n")
    return c.sql(f"SELECT norm AS url, CAST(min(page_id) AS VARCHAR) AS ord FROM {{prev}} WHERE NOT {O.is_blacklisted('_n_path')} GROUP BY norm "
                 "QUALIFY row_number() OVER (ORDER BY min(page_id), norm) <= greatest((SELECT count(*) FROM pages) // 3, 1)")


@register("hot_job_budget", _budget_sql())
def q_hot_job_budget(spark, d):
    """One job that owns every URL of the table, with a budget of a third of the captures."""
    pages = _pages(spark, d)
    jobs = _graph_job(spark, max(pages.count() // 3, 1), 1)
    listed = pages.select(F.lit("graph").alias("job_id"), F.col("url").alias("loc"), F.array("page_id").alias("ord"))
    fetched = normalize_urls(pages.select("url"), "url", "norm").select(F.col("norm").alias("url")).filter("url IS NOT NULL")
    links = spark.createDataFrame([], "src_url string, position int, dst_url string")
    got = FR.crawl_frontier(jobs, links, fetched, listed, scope=FR.any_host)
    return got.select("url", F.element_at("ord", -1).cast("string").alias("ord"))
