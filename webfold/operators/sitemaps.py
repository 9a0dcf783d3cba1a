"""Sitemap scan, index expansion, location fallback, dedup.

Input: captured sitemap documents ``(doc_url, status, body)``.

* S2/S3 parse: ``from_xml`` with a fixed schema reads both ``<urlset>`` and
  ``<sitemapindex>`` (told apart by the root tag; other roots and malformed
  bodies go to :func:`sitemap_errors`), then ``posexplode`` keeps document order.
* S3 expansion is an iterative equi-join ``child_loc = doc_url`` against the
  documents table, one Spark job per nesting level, with a ``left_anti`` on
  already-seen documents so cyclic indexes end.  Each level is checkpointed to
  the shared checkpoint folder (lineage stays short, lost executors recompute
  from there).
* S4 picks, per job, the first root (``/sitemap.xml``, then
  ``/sitemap_index.xml``) that yields at least one URL: ``min_by`` on priority.
* A4 keeps the first occurrence of each URL (``groupBy`` + ``min`` of the
  order key — partial aggregation, no window over a hot job).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webfold.constants import SITEMAP_PATHS
from webfold.functions.urls import parse_urls, resolve_urls, url_part_columns

SITEMAP_XML_SCHEMA = "url array<struct<loc:string>>, sitemap array<struct<loc:string>>"
# Go's strings.TrimSpace on loc; from_xml already trims ASCII space.
LOC_TRIM = r"^[\t\n\x0B\f\r \x{85}\p{Z}]+|[\t\n\x0B\f\r \x{85}\p{Z}]+\z"


ROOT_TAG = r"(?s)^\x{FEFF}?(?:\s|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>]*>)*<(?:[A-Za-z_][\w.-]*:)?([A-Za-z_][\w.-]*)"


def _parsed(docs: DataFrame) -> DataFrame:
    """Root tag and entries of each captured (status 200) document, the whole body parsed."""
    return (docs.filter(F.col("status") == 200)
            .select("doc_url", F.regexp_extract("body", ROOT_TAG, 1).alias("root"),
                    F.from_xml(F.col("body"), SITEMAP_XML_SCHEMA, {"mode": "PERMISSIVE"}).alias("x")))


def sitemap_locs(docs: DataFrame) -> DataFrame:
    """S2 (+F11): one row per ``<loc>``: (doc_url, kind 'url'|'sitemap',
    position, loc).  Non-200 documents and blank locs are dropped; a document
    is an index if its root is ``sitemapindex``, a list if it is ``urlset``,
    and else no sitemap.  F11's size limit guards a fetch; captured bodies are
    parsed whole."""
    d = _parsed(docs)
    idx = d.filter(F.col("root") == "sitemapindex").select("doc_url", F.lit("sitemap").alias("kind"),
                                                           F.posexplode("x.sitemap").alias("position", "e"))
    us = d.filter(F.col("root") == "urlset").select("doc_url", F.lit("url").alias("kind"),
                                                    F.posexplode("x.url").alias("position", "e"))
    out = idx.unionByName(us).select("doc_url", "kind", F.col("position").cast("int").alias("position"),
                                     F.regexp_replace(F.coalesce(F.col("e.loc"), F.lit("")), LOC_TRIM, "").alias("loc"))
    return out.filter(F.col("loc") != "")


def sitemap_errors(docs: DataFrame) -> DataFrame:
    """Documents that give no entries: (doc_url, error)."""
    bad = docs.filter(~F.coalesce(F.col("status") == 200, F.lit(False))).select(
        "doc_url", F.concat(F.lit("http status "), F.coalesce(F.col("status").cast("string"), F.lit("unknown"))).alias("error"))
    unread = _parsed(docs).select("doc_url", (
        F.when(~F.coalesce(F.col("root").isin("urlset", "sitemapindex"), F.lit(False)), F.lit("no sitemap"))
        .when(F.col("x").isNull() | (F.col("x.url").isNull() & F.col("x.sitemap").isNull()), F.lit("malformed or empty"))).alias("error"))
    return bad.unionByName(unread.filter("error IS NOT NULL"))


def feed_links(docs: DataFrame) -> DataFrame:
    """Entries of captured RSS and Atom feeds as (doc_url, position, loc)."""
    schema = ("channel struct<item:array<struct<link:string>>>, entry array<struct<link:array<struct<_href:string,_rel:string>>>>")
    d = (docs.filter(F.col("status") == 200).select("doc_url", F.regexp_extract("body", ROOT_TAG, 1).alias("root"),
                                                    F.from_xml(F.col("body"), schema, {"mode": "PERMISSIVE"}).alias("x")))
    atom = F.transform("x.entry", lambda e: F.try_element_at(F.filter(e["link"], lambda k: F.coalesce(k["_rel"], F.lit("alternate")) == "alternate"),
                                                             F.lit(1))["_href"])
    rss = F.transform("x.channel.item", lambda e: e["link"])
    locs = F.when(F.col("root") == "rss", rss).when(F.col("root") == "feed", atom)
    return (d.select("doc_url", F.posexplode(locs).alias("position", "loc"))
            .withColumn("loc", F.regexp_replace(F.coalesce("loc", F.lit("")), LOC_TRIM, "")).filter(F.col("loc") != ""))


def sitemap_roots(jobs: DataFrame) -> DataFrame:
    """S4/S5 candidates: ``https://<domain>`` + each sitemap path, with its
    priority (0 = tried first)."""
    base = F.concat(F.lit("https://"), F.col("domain"))
    paths = F.array(*[F.struct(F.lit(i).alias("prio"), F.lit(p).alias("path")) for i, p in enumerate(SITEMAP_PATHS)])
    return jobs.select("job_id", "domain", F.explode(paths).alias("r")).select(
        "job_id", "domain", F.col("r.prio").alias("prio"), F.concat(base, F.col("r.path")).alias("root_url"))


def _child_guard(df: DataFrame, parent: str, loc: str, out: str, domain: str) -> DataFrame:
    """resolve a child sitemap against its parent; keep http(s) on the
    job's domain or its www variant."""
    df = resolve_urls(df, parent, loc, out)
    df = parse_urls(df, out, "_c")
    d = F.regexp_replace(F.lower(F.trim(F.col(domain))), r"^www\.", "")
    ok = (F.col("_c_ok") & F.col("_c_scheme").isin("http", "https")
          & ((F.col("_c_host") == d) | (F.col("_c_host") == F.concat(F.lit("www."), d))))
    df = df.withColumn("_child_ok", F.coalesce(ok, F.lit(False)))
    return df.filter("_child_ok").drop("_child_ok", *url_part_columns("_c"))


def expand_sitemaps(roots: DataFrame, docs: DataFrame, checkpoint: bool = True) -> DataFrame:
    """S3/O2: page URLs reachable from each root, with an order key.

    ``roots``: (job_id, domain, prio, root_url).  Returns (job_id, prio,
    ord array<int>, loc) where ``ord`` is the path of positions from the
    root (document order).  Cycles end via the anti-join on seen documents.
    Each level is written once; the result is the union of the levels.
    """
    # parse every document once; later levels join against the written table
    locs = sitemap_locs(docs)
    if checkpoint:
        locs = locs.checkpoint()
    frontier = roots.select("job_id", "domain", "prio", F.col("root_url").alias("doc_url"),
                            F.array().cast("array<int>").alias("ord"))
    seen = frontier.select("job_id", "prio", "doc_url")
    out = None
    while True:
        entries = frontier.join(locs, "doc_url")
        if checkpoint:
            entries = entries.checkpoint()
        urls = entries.filter(F.col("kind") == "url").select(
            "job_id", "prio", F.concat("ord", F.array(F.col("position"))).alias("ord"), "loc")
        out = urls if out is None else out.unionByName(urls)
        children = entries.filter(F.col("kind") == "sitemap").select(
            "job_id", "domain", "prio", "doc_url", F.concat("ord", F.array(F.col("position"))).alias("ord"), "loc")
        children = _child_guard(children, "doc_url", "loc", "child_url", "domain")
        # first path to each child wins; a child already expanded is skipped
        children = (children.groupBy("job_id", "domain", "prio", F.col("child_url").alias("doc_url"))
                    .agg(F.min("ord").alias("ord")))
        children = children.join(seen, ["job_id", "prio", "doc_url"], "left_anti")
        if checkpoint:
            children = children.checkpoint()
        if children.isEmpty():
            break
        seen = seen.unionByName(children.select("job_id", "prio", "doc_url"))
        frontier = children
    return out


def pick_sitemap(expanded: DataFrame) -> DataFrame:
    """Per job, keep the URLs of the lowest-priority root that yields any."""
    best = expanded.groupBy("job_id").agg(F.min("prio").alias("prio"))
    return expanded.join(best, ["job_id", "prio"], "left_semi")


def dedup_sitemap_urls(picked: DataFrame) -> DataFrame:
    """A4: first occurrence of each URL per job, with its 0-based rank in
    discovery order (``ord`` ordering; ties impossible within one job)."""
    first = picked.groupBy("job_id", "loc").agg(F.min("ord").alias("ord"))
    return first


def sitemap_seed_urls(jobs: DataFrame, docs: DataFrame, checkpoint: bool = True) -> DataFrame:
    """S4 + S3 + A4 for every job: (job_id, ord, loc)."""
    return dedup_sitemap_urls(pick_sitemap(expand_sitemaps(sitemap_roots(jobs), docs, checkpoint=checkpoint)))
