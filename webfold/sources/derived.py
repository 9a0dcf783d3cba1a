"""Tables Spark derives from the captured pages for discovery.

The corpus holds pages but no sitemap documents and no crawl-job rows, so
both are derived here from ``pages`` (they grow with it), by narrow maps:

* jobs: one per domain (host without ``www.``), without limits unless given;
* sitemap documents: one small ``<urlset>`` per page, naming the page, as a
  capture of its domain's ``/sitemap.xml``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webfold.functions.urls import allowed_domains, domain_of_host, parse_urls

URLSET = '<?xml version="1.0" encoding="UTF-8"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'


def _xml_escape(c):
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def page_hosts(pages: DataFrame) -> DataFrame:
    df = parse_urls(pages.select("page_id", "url"), "url", "u")
    return df.filter(F.col("u_ok") & (F.col("u_host") != "")).select("page_id", "url", domain_of_host(F.col("u_host")).alias("domain"))


def derive_jobs(pages: DataFrame, max_pages: int = 0, max_depth: int = 0, mode: str = "both") -> DataFrame:
    d = page_hosts(pages).select("domain").distinct()
    return d.select(F.col("domain").alias("job_id"), "domain",
                    allowed_domains(F.col("domain")).alias("allowed_domains"),
                    F.lit(max_pages).alias("max_pages"), F.lit(max_depth).alias("max_depth"),
                    F.lit("markdown").alias("output_format"), F.lit(mode).alias("discovery_mode"))


def derive_sitemap_docs(pages: DataFrame) -> DataFrame:
    body = F.concat(F.lit(URLSET + "<url><loc>"), _xml_escape(F.col("url")), F.lit("</loc></url></urlset>"))
    return page_hosts(pages).select(F.concat(F.lit("https://"), F.col("domain"), F.lit("/sitemap.xml")).alias("doc_url"),
                                    F.lit(200).alias("status"), body.alias("body"))
