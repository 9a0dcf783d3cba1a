"""The link graph of captured pages.

``page_links`` is a narrow map + ``posexplode`` (no shuffle).  Scoping to a
crawl job (J1) is an equi-join on ``(job_id, host)`` against the job's
allowed hosts (:mod:`webfold.operators.frontier`); AQE chooses a broadcast at run time
where that side is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webfold.functions import text as T
from webfold.functions.urls import (BASE_PARTS, allowed_domains, domain_of_host, normalize_urls, parse_urls,
                                    resolve_urls, url_part_columns, is_blacklisted_path, is_article_path)
from webfold.operators.extract import preclean_html

HREF_IN_A = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
BASE_HREF = r"""(?is)<base\b[^>]*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
# leading/trailing ASCII whitespace and C0 controls are not part of an href
HREF_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+\z"


def page_links(pages: DataFrame, key: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Every ``a[href]`` of every page as (``key``, ``src_url``, ``position``,
    ``href``, ``abs_url``, ``dst_url``).  ``src_url`` is the normalised page
    URL (the request URL), ``position`` is 0-based in document order,
    ``dst_url`` the normalised absolute target; rows whose target does not
    resolve or normalise are dropped (F8) and so are same-page anchors."""
    df = pages.select(key, F.col(url_col).alias("_page_url"),
                      T.trim_ws(T.decode_entities(T.quoted_attr_value(F.regexp_extract(html_col, BASE_HREF, 1)))).alias("_base"),
                      F.regexp_extract_all(preclean_html(F.col(html_col)), F.lit(HREF_IN_A), 1).alias("_hrefs"))
    df = normalize_urls(df, "_page_url", "src_url").drop("_page_url")
    # links stand relative to <base href> where a page has one; an empty one resolves to the page itself
    df = resolve_urls(df, "src_url", "_base", "_base_abs")
    # the base is parsed once a page; its parts go with the links
    df = parse_urls(df.withColumn("_from", F.coalesce("_base_abs", "src_url")), "_from", "_f")
    df = df.select(key, "src_url", "_from", *[f"_f_{part}" for part in BASE_PARTS], F.posexplode("_hrefs").alias("position", "_raw"))
    df = df.withColumn("href", F.regexp_replace(T.decode_entities(T.quoted_attr_value(F.col("_raw"))), HREF_TRIM, ""))
    df = resolve_urls(df, "_from", "href", "abs_url", base_parts="_f")
    df = normalize_urls(df, "abs_url", "dst_url")
    return df.filter(F.col("dst_url").isNotNull() & F.col("src_url").isNotNull()).select(
        key, "src_url", F.col("position").cast("int").alias("position"), "href", "abs_url", "dst_url")


def link_flags(links: DataFrame, url: str = "dst_url", src: str = "src_url") -> DataFrame:
    """F1-F4 per link for the job that owns the source page (one job per
    domain): ``dst_host``, ``in_scope``, ``blacklisted``, ``allowed``,
    ``likely_article``."""
    df = parse_urls(links, url, "_d")
    df = parse_urls(df, src, "_s")
    dom = domain_of_host(F.col("_s_host"))
    df = df.withColumn("_allowed_hosts", allowed_domains(dom))
    in_scope = F.col("_d_ok") & F.array_contains(F.col("_allowed_hosts"), F.col("_d_host"))
    black = F.col("_d_ok") & is_blacklisted_path(F.col("_d_path"))
    df = df.withColumns({
        "job_id": dom,
        "dst_host": F.col("_d_host"),
        "in_scope": F.coalesce(in_scope, F.lit(False)),
        "blacklisted": F.coalesce(black, F.lit(False)),
        "likely_article": F.coalesce(F.col("_d_ok") & is_article_path(F.col("_d_path")), F.lit(False)),
    })
    df = df.withColumn("allowed", F.col("in_scope") & ~F.col("blacklisted"))
    return df.drop(*url_part_columns("_d"), *url_part_columns("_s"), "_allowed_hosts")


def link_graph_summary(flagged: DataFrame) -> DataFrame:
    """Per source host: links, distinct targets, in-scope and blacklisted share
    (partial aggregation; ``count_distinct`` is exact)."""
    df = parse_urls(flagged, "src_url", "_s")
    return (df.groupBy(F.col("_s_host").alias("host"))
            .agg(F.count("*").alias("n_links"),
                 F.count_distinct("dst_url").alias("n_targets"),
                 F.sum(F.col("in_scope").cast("long")).alias("n_in_scope"),
                 F.sum(F.col("blacklisted").cast("long")).alias("n_blacklisted"),
                 F.sum(F.col("allowed").cast("long")).alias("n_allowed"),
                 F.sum(F.col("likely_article").cast("long")).alias("n_article_like")))
