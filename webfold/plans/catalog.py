"""Registered queries: a Spark plan over the input tables and its DuckDB oracle.

Every query reads the given tables (or tables Spark derives from them) in
full.  Output columns are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webfold.functions import text as T
from webfold.functions.urls import (allowed_domains, domain_of_host, normalize_urls, parse_urls,
                                    relative_paths)
from webfold.operators import extract as E
from webfold.operators import links as L
from webfold.operators import pages as P
from webfold.plans import oracle as O
from webfold.sources import derived as DV
from webfold.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

MIN_WORDS = 250
CRAWLED_AT_SQL = "TIMESTAMP '2026-01-01 00:00:00'"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _pages(spark, d):
    _prepare(spark)
    return read_table(spark, d, "pages")


def _prepare(spark):
    """The checkpoint folder of the caller's session; its settings stay as they are."""
    from webfold.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)


def _extracted(spark, d):
    return E.extract_articles(_pages(spark, d))


# ------------------------------------------------------------------ oracle building blocks

def _extract_sql(final: str) -> str:
    return O.extract_chain("SELECT page_id, url, html FROM pages").sql(final)


def _long_chain() -> O.Chain:
    c = O.extract_chain("SELECT page_id, url, html FROM pages")
    c.step(f"SELECT * FROM {{prev}} WHERE norm_url IS NOT NULL AND word_count >= {MIN_WORDS}")
    return c


# ------------------------------------------------------------------ U1 / U3 / U6

register("normalize_url", O.normalize_cols(O.Chain("SELECT page_id, url FROM pages"), "url", "norm_url")
         .sql("SELECT page_id, url, norm_url FROM {prev}"))(
    lambda spark, d: normalize_urls(_pages(spark, d).select("page_id", "url"), "url", "norm_url"))


def _url_parts_spark(spark, d):
    df = parse_urls(_pages(spark, d).select("page_id", "url"), "url", "u")
    return df.select("page_id", F.col("u_scheme").alias("scheme"), F.col("u_host").alias("host"),
                     F.col("u_path").alias("path"), F.col("u_query").alias("query"))


register("url_host", O.parse_url_cols(O.Chain("SELECT page_id, url FROM pages"), "url", "u")
         .sql("SELECT page_id, u_scheme AS scheme, u_host AS host, u_path AS path, u_query AS query FROM {prev}"))(
    _url_parts_spark)


def _relpath_sql() -> str:
    c = O.normalize_cols(O.Chain("SELECT page_id, url FROM pages"), "url", "norm_url")
    O.relative_path_cols(c, "norm_url", "relative_path")
    return c.sql("SELECT page_id, norm_url, relative_path, substr(sha256(norm_url), 1, 6) AS short_hash FROM {prev}")


@register("relative_path", _relpath_sql())
def q_relative_path(spark, d):
    df = normalize_urls(_pages(spark, d).select("page_id", "url"), "url", "norm_url")
    df = relative_paths(df, "norm_url", "relative_path")
    return df.select("page_id", "norm_url", "relative_path",
                     F.substring(F.sha2("norm_url", 256), 1, 6).alias("short_hash"))


# ------------------------------------------------------------------ U4 / jobs

def _jobs_sql_chain() -> O.Chain:
    c = O.parse_url_cols(O.Chain("SELECT url FROM pages"), "url", "u")
    c.step("SELECT DISTINCT regexp_replace(lower(u_host), '^www\\.', '') AS domain FROM {prev} WHERE u_ok AND u_host <> ''")
    return c


register("allowed_domains", _jobs_sql_chain().sql(
    "SELECT domain AS job_id, regexp_replace(lower(trim(domain)), '^www\\.', '') AS allowed_1, "
    "'www.' || regexp_replace(lower(trim(domain)), '^www\\.', '') AS allowed_2 FROM {prev}"))(
    lambda spark, d: DV.derive_jobs(_pages(spark, d)).select(
        "job_id", F.col("allowed_domains")[0].alias("allowed_1"), F.col("allowed_domains")[1].alias("allowed_2")))


# ------------------------------------------------------------------ E4 / F5 / E1 / F6

register("preclean_html", (
    "SELECT page_id, length(c) AS clean_chars, sha256(c) AS clean_hash FROM ("
    f"SELECT page_id, {O.rx_replace('coalesce(html, ' + chr(39) * 2 + ')', T.PRECLEAN, '')} AS c FROM pages)"))(
    lambda spark, d: _pages(spark, d).select("page_id", E.preclean_html(F.col("html")).alias("c"))
    .select("page_id", F.length("c").alias("clean_chars"), F.sha2("c", 256).alias("clean_hash")))

def _captures(spark, d):
    """Pages with a status and a content type, derived from the URL's form (the corpus records neither)."""
    u = F.col("url")
    return _pages(spark, d).withColumns({
        "status_code": F.when(u.contains("/es/"), 404).when(u.contains("ref="), 301).when(u.contains("/fr/"), F.lit(None).cast("int")).otherwise(200),
        "content_type": F.when(u.contains("#"), "application/pdf").when(u.endswith(".html"), "TEXT/HTML; charset=utf-8")
        .when(u.contains("/de/"), "application/xhtml+xml").when(u.contains("/en/"), F.lit(None).cast("string")).otherwise("")})


_CAPTURES_SQL = ("SELECT *, CAST(CASE WHEN url LIKE '%/es/%' THEN 404 WHEN url LIKE '%ref=%' THEN 301 WHEN url LIKE '%/fr/%' THEN NULL ELSE 200 END AS INTEGER) AS status_code, "
                 "CASE WHEN url LIKE '%#%' THEN 'application/pdf' WHEN url LIKE '%.html' THEN 'TEXT/HTML; charset=utf-8' "
                 "WHEN url LIKE '%/de/%' THEN 'application/xhtml+xml' WHEN url LIKE '%/en/%' THEN NULL ELSE '' END AS content_type FROM pages")

register("html_only", "SELECT page_id, coalesce(content_type, '') = '' OR lower(content_type) LIKE '%text/html%' "
         f"OR lower(content_type) LIKE '%application/xhtml+xml%' AS is_html FROM ({_CAPTURES_SQL})")(
    lambda spark, d: _captures(spark, d).select("page_id", E.is_html_content_type(F.col("content_type")).alias("is_html")))

register("gated_articles", O.extract_chain(
    f"SELECT * FROM ({_CAPTURES_SQL}) WHERE (status_code IS NULL OR status_code BETWEEN 200 AND 299) AND (coalesce(content_type, '') = '' "
    "OR lower(content_type) LIKE '%text/html%' OR lower(content_type) LIKE '%application/xhtml+xml%')", keep=("page_id", "status_code", "content_type")).sql(
    "SELECT page_id, norm_url, word_count, coalesce(status_code, 0) AS status_code, content_type FROM {prev}"))(
    lambda spark, d: E.extract_articles(E.capture_gate(_captures(spark, d)), keep=("page_id", "status_code", "content_type"))
    .select("page_id", "norm_url", "word_count", F.coalesce("status_code", F.lit(0)).alias("status_code"), "content_type"))

_EXTRACT_COLS = ["page_id", "norm_url", "title", "byline", "site_name", "language", "canonical_url",
                 "excerpt", "word_count", "text_content"]

register("extract_articles", _extract_sql(f"SELECT {', '.join(_EXTRACT_COLS)} FROM {{prev}}"))(
    lambda spark, d: _extracted(spark, d).select(*_EXTRACT_COLS))

register("long_articles", _long_chain().sql("SELECT page_id, norm_url, word_count FROM {prev}"))(
    lambda spark, d: E.long_articles(_extracted(spark, d), MIN_WORDS)
    .filter(F.col("norm_url").isNotNull()).select("page_id", "norm_url", "word_count"))


# ------------------------------------------------------------------ E2 / U11-U14 / K2 / E3

def _md_chain() -> O.Chain:
    c = _long_chain()
    c.add({"_md1": O.markdown_expr("content_html")})
    c.add({"markdown": O.markdown_finish("_md1")})
    return c


register("markdown_pages", _md_chain().sql("SELECT page_id, markdown FROM {prev}"))(
    lambda spark, d: P.to_markdown(E.long_articles(_extracted(spark, d), MIN_WORDS)
                                   .filter(F.col("norm_url").isNotNull())).select("page_id", "markdown"))


def _fm_sql(e_url, e_canon, e_title, e_byline, e_site, e_ts, e_wc, e_hash) -> str:
    def field(k, v):
        return f"'{k}: ' || {O.go_quote(v)} || chr(10)"

    def optional(k, v):
        return f"CASE WHEN coalesce({v}, '') <> '' THEN {field(k, v)} ELSE '' END"

    return ("'---' || chr(10) || " + " || ".join([
        field("url", e_url), optional("canonical_url", e_canon), field("title", e_title),
        optional("byline", e_byline), optional("site_name", e_site),
        field("crawled_at", O.rfc3339(e_ts)),
        f"'word_count: ' || CAST({e_wc} AS VARCHAR) || chr(10)",
        field("content_hash", e_hash)]) + " || '---' || chr(10)")


def _crawled_chain() -> O.Chain:
    c = _md_chain()
    O.relative_path_cols(c, "norm_url", "relative_path")
    c.add({"content_hash": "sha256(text_content)", "crawled_at": CRAWLED_AT_SQL})
    fm = _fm_sql("norm_url", "canonical_url", "title", "byline", "site_name", "crawled_at", "word_count",
                 "content_hash")
    c.add({"front_matter": fm})
    c.add({"markdown_content": "front_matter || chr(10) || markdown || chr(10)"})
    return c


register("front_matter", _crawled_chain().sql("SELECT page_id, front_matter FROM {prev}"))(
    lambda spark, d: _q_crawled(spark, d).select(
        "page_id", F.regexp_extract("markdown_content", r"(?s)^(---\n.*?\n---\n)", 1).alias("front_matter")))

_CRAWLED_COLS = ["page_id", "url", "relative_path", "title", "word_count", "content_hash", "markdown_content",
                 "extraction_method", "http_status"]


def _q_crawled(spark, d):
    return P.crawled_pages(_extracted(spark, d), MIN_WORDS)


register("crawled_pages", _crawled_chain().sql(
    "SELECT page_id, norm_url AS url, relative_path, title, word_count, content_hash, markdown_content, "
    "'readability' AS extraction_method, 200 AS http_status FROM {prev}"))(
    lambda spark, d: _q_crawled(spark, d).select(*_CRAWLED_COLS))


def _manifest_sql() -> str:
    c = _long_chain()
    c.step("SELECT page_id, norm_url, canonical_url, title, word_count, sha256(text_content) AS content_hash "
           "FROM {prev} QUALIFY row_number() OVER (PARTITION BY norm_url ORDER BY page_id) = 1")
    O.relative_path_cols(c, "norm_url", "relative_path")
    return c.sql(f"SELECT norm_url AS url, canonical_url, relative_path, title, word_count, content_hash, "
                 f"{O.rfc3339(CRAWLED_AT_SQL)} AS crawled_at, 'ok' AS status FROM {{prev}}")


def q_article_manifest(spark, d):
    return P.manifest_rows(_extracted(spark, d), MIN_WORDS)


register("article_manifest", _manifest_sql())(q_article_manifest)


# ------------------------------------------------------------------ F12

def _errors_sql(source: str = _CAPTURES_SQL) -> str:
    c = O.normalize_cols(O.Chain(f"SELECT page_id, url, html, status_code, content_type FROM ({source})"), "url", "_norm", p="_u")
    html = "(coalesce(content_type, '') = '' OR lower(content_type) LIKE '%text/html%' OR lower(content_type) LIKE '%application/xhtml+xml%')"
    c.add({"phase": "CASE WHEN _norm IS NULL THEN 'normalize' WHEN status_code NOT BETWEEN 200 AND 299 THEN 'fetch' WHEN html IS NULL THEN 'fetch' "
                    f"WHEN NOT {html} THEN 'filter' WHEN NOT coalesce({O.rx_like('html', '<[A-Za-z!/]')}, false) THEN 'extract' WHEN _u_host = '' THEN 'save' END",
           "error": "CASE WHEN _norm IS NULL THEN 'invalid page URL' WHEN status_code NOT BETWEEN 200 AND 299 THEN 'http status ' || status_code "
                    f"WHEN html IS NULL THEN 'empty body' WHEN NOT {html} THEN 'not html: ' || content_type "
                    f"WHEN NOT coalesce({O.rx_like('html', '<[A-Za-z!/]')}, false) THEN 'no markup to extract' "
                    "WHEN _u_host = '' THEN 'path generation: URL has no host' END"})
    return c.sql("SELECT page_id, url, coalesce(status_code, 0) AS http_status, error, phase FROM {prev} WHERE phase IS NOT NULL")


register("error_rows", _errors_sql())(
    lambda spark, d: E.page_errors(_captures(spark, d)).withColumn("http_status", F.coalesce("http_status", F.lit(0))))


# ------------------------------------------------------------------ documents: U9 / U10 / U11 / A7

def _docs(spark, d):
    _prepare(spark)
    return read_table(spark, d, "documents")


register("word_count", f"SELECT doc_id, {O.word_count('text')} AS word_count FROM documents")(
    lambda spark, d: _docs(spark, d).select("doc_id", T.word_count(F.col("text")).alias("word_count")))

register("content_hash", "SELECT doc_id, sha256(text) AS content_hash FROM documents")(
    lambda spark, d: _docs(spark, d).select("doc_id", P.content_hash(F.col("text")).alias("content_hash")))

register("normalize_markdown", f"SELECT doc_id, sha256({O.normalize_markdown('text')}) AS norm_hash, "
         f"length({O.normalize_markdown('text')}) AS norm_chars FROM documents")(
    lambda spark, d: _docs(spark, d).select("doc_id", T.normalize_markdown(F.col("text")).alias("n"))
    .select("doc_id", F.sha2("n", 256).alias("norm_hash"), F.length("n").alias("norm_chars")))

register("content_dedup", "SELECT doc_id, sha256(text) AS content_hash FROM documents "
         "QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1")(
    lambda spark, d: P.content_dedup(
        _docs(spark, d).select("doc_id", P.content_hash(F.col("text")).alias("content_hash")), key="doc_id"))


# ------------------------------------------------------------------ S6 / U8 / F1-F4

def _links_chain() -> O.Chain:
    pre = O.rx_replace("coalesce(html, '')", T.PRECLEAN, "")
    c = O.Chain(f"SELECT page_id, url, regexp_extract_all({pre}, {O.q(L.HREF_IN_A)}, 1) AS _hrefs FROM pages", "l")
    O.normalize_cols(c, "url", "src_url")
    c.step("SELECT page_id, src_url, CAST(i - 1 AS INTEGER) AS position, _hrefs[i] AS _raw "
           "FROM {prev}, generate_series(1, len(_hrefs)) AS t(i)")
    href = O.rx_replace(O.decode_entities(O.rx_replace("_raw", T.QUOTES, "")), L.HREF_TRIM, "")
    c.add({"href": href})
    O.resolve_cols(c, "src_url", "href", "abs_url")
    O.normalize_cols(c, "abs_url", "dst_url")
    c.step("SELECT * FROM {prev} WHERE dst_url IS NOT NULL AND src_url IS NOT NULL")
    return c


_LINK_COLS = ["page_id", "src_url", "position", "href", "abs_url", "dst_url"]


def q_page_links(spark, d):
    return L.page_links(_pages(spark, d))


register("page_links", _links_chain().sql(f"SELECT {', '.join(_LINK_COLS)} FROM {{prev}}"))(q_page_links)
register("resolve_links", _links_chain().sql("SELECT page_id, position, href, abs_url FROM {prev}"))(
    lambda spark, d: q_page_links(spark, d).select("page_id", "position", "href", "abs_url"))


def _collision_sql() -> str:
    c = _links_chain().step("SELECT DISTINCT dst_url FROM {prev}")
    O.relative_path_cols(c, "dst_url", "relative_path")
    return c.sql("SELECT relative_path, count(*) AS n_urls, min(dst_url) AS first_url, max(dst_url) AS last_url FROM {prev} "
                 "GROUP BY relative_path HAVING count(*) > 1")


register("path_collisions", _collision_sql())(lambda spark, d: P.path_collisions(
    relative_paths(q_page_links(spark, d).select(F.col("dst_url").alias("url")).distinct(), "url", "relative_path")))


def _flags_chain() -> O.Chain:
    c = _links_chain()
    O.parse_url_cols(c, "dst_url", "_d")
    O.parse_url_cols(c, "src_url", "_s")
    c.add({"job_id": "regexp_replace(lower(_s_host), '^www\\.', '')"})
    in_scope = "coalesce(_d_ok AND (_d_host = job_id OR _d_host = 'www.' || job_id), false)"
    c.add({"dst_host": "_d_host", "in_scope": in_scope,
           "blacklisted": f"coalesce(_d_ok AND {O.is_blacklisted('_d_path')}, false)",
           "likely_article": f"coalesce(_d_ok AND {O.is_article('_d_path')}, false)"})
    c.add({"allowed": "in_scope AND NOT blacklisted"})
    return c


def q_link_flags(spark, d):
    return L.link_flags(q_page_links(spark, d))


for _name, _col in (("in_scope", "in_scope"), ("url_blacklist", "blacklisted"), ("url_allow", "allowed"),
                    ("likely_article", "likely_article")):
    register(_name, _flags_chain().sql(f"SELECT page_id, position, dst_url, {_col} FROM {{prev}}"))(
        (lambda c: lambda spark, d: q_link_flags(spark, d).select("page_id", "position", "dst_url", c))(_col))


register("link_graph", _flags_chain().sql(
    "SELECT _s_host AS host, count(*) AS n_links, count(DISTINCT dst_url) AS n_targets, "
    "CAST(sum(in_scope::BIGINT) AS BIGINT) AS n_in_scope, CAST(sum(blacklisted::BIGINT) AS BIGINT) AS n_blacklisted, "
    "CAST(sum(allowed::BIGINT) AS BIGINT) AS n_allowed, CAST(sum(likely_article::BIGINT) AS BIGINT) AS n_article_like "
    "FROM {prev} GROUP BY _s_host"))(
    lambda spark, d: L.link_graph_summary(q_link_flags(spark, d)))


# ------------------------------------------------------------------ jobs, sitemaps, frontier

from webfold.operators import frontier as FR  # noqa: E402
from webfold.operators import sitemaps as SM  # noqa: E402


def _jobs(spark, d, **kw):
    return FR.validate_jobs(DV.derive_jobs(_pages(spark, d), **kw))


register("jobs_validated", _jobs_sql_chain().step(
    "SELECT domain, length(domain) - 20 AS max_pages, CASE WHEN domain LIKE '%.org' THEN 'rss' WHEN domain LIKE '%.net' THEN ' Links' ELSE 'both' END AS mode FROM {prev}").sql(
    "SELECT domain AS job_id, lower(trim(mode)) AS discovery_mode, CASE WHEN max_pages < 0 THEN 'max_pages must be >= 0' "
    "WHEN mode = 'rss' THEN 'invalid discovery mode: rss' END AS reject_reason FROM {prev}"))(
    lambda spark, d: FR.validate_jobs(DV.derive_jobs(_pages(spark, d)).withColumns({
        "max_pages": F.length("domain") - 20,
        "discovery_mode": F.when(F.col("domain").endswith(".org"), "rss").when(F.col("domain").endswith(".net"), " Links").otherwise("both")}))
    .select("job_id", "discovery_mode", "reject_reason"))


def _sm_base_sql() -> O.Chain:
    c = O.parse_url_cols(O.Chain("SELECT page_id, url FROM pages"), "url", "u")
    c.step("SELECT page_id, url, regexp_replace(lower(u_host), '^www\\.', '') AS domain FROM {prev} WHERE u_ok AND u_host <> ''")
    return c


register("sitemap_locs", _sm_base_sql().sql(
    "SELECT 'https://' || domain || '/sitemap.xml' AS doc_url, 'url' AS kind, CAST(0 AS INTEGER) AS position, url AS loc FROM {prev}"))(
    lambda spark, d: SM.sitemap_locs(DV.derive_sitemap_docs(_pages(spark, d))))


def q_sitemap_seeds(spark, d):
    return SM.sitemap_seed_urls(_jobs(spark, d), DV.derive_sitemap_docs(_pages(spark, d)))


register("sitemap_seeds", _sm_base_sql().sql("SELECT DISTINCT domain AS job_id, url AS loc, '0' AS ord FROM {prev}"))(
    lambda spark, d: q_sitemap_seeds(spark, d).select("job_id", "loc", F.array_join(F.col("ord"), ".").alias("ord")))


def _norm_links(spark, d):
    return q_page_links(spark, d).select("src_url", "position", "dst_url")


def _fetched(spark, d):
    return normalize_urls(_pages(spark, d).select("url"), "url", "norm").select(F.col("norm").alias("url")).filter(
        F.col("url").isNotNull())


def q_crawl_frontier(spark, d):
    pages = _pages(spark, d)
    jobs = _jobs(spark, d).filter(F.col("reject_reason").isNull())
    sm = SM.sitemap_seed_urls(jobs, DV.derive_sitemap_docs(pages))
    return FR.crawl_frontier(jobs, _norm_links(spark, d), _fetched(spark, d), sm)


def _frontier_levels(budget: int | None, depth: int) -> str:
    """Level-wise SQL of the frontier: ``f`` (job_id, url, depth, ord list, captured).

    Seeds, then ``depth`` - 1 expansions; unlimited runs end by then as no
    link of this corpus reaches another captured page twice.
    """
    def norm(source: str, url: str, name: str) -> O.Chain:
        c = O.normalize_cols(O.Chain(source, name), url, "norm")
        O.parse_url_cols(c, "norm", "_n")
        return c
    pages = norm("SELECT page_id, url FROM pages", "url", "fp").sql(
        f"SELECT norm, _n_host AS host, regexp_replace(lower(_n_host), '^www\\.', '') AS job_id, coalesce(NOT {O.is_blacklisted('_n_path')}, false) AS ok "
        "FROM {prev} WHERE norm IS NOT NULL AND _n_host <> ''")
    links = _links_chain()
    O.parse_url_cols(links, "dst_url", "_d")
    links = links.sql(f"SELECT src_url, position, dst_url, _d_host AS host FROM {{prev}} WHERE _d_ok AND NOT {O.is_blacklisted('_d_path')}")
    rank = "row_number() OVER (PARTITION BY job_id ORDER BY ord, url)"
    parts = [f"p AS MATERIALIZED ({pages})", f"e AS MATERIALIZED ({links})",
             "s AS (SELECT job_id, url, min(ord) AS ord FROM (SELECT job_id, norm AS url, [0, 0]::BIGINT[] AS ord FROM p WHERE ok "
             "UNION ALL SELECT DISTINCT job_id, 'https://' || job_id || '/', [1]::BIGINT[] FROM p) GROUP BY ALL)",
             f"l1 AS (SELECT job_id, url, ord, 1 AS depth FROM (SELECT *, {rank} AS r FROM s) " + (f"WHERE r <= {budget})" if budget else ")"),
             "f1 AS (SELECT * FROM l1)"]
    for k in range(2, depth + 1):
        parts.append(f"c{k} AS (SELECT a.job_id, e.dst_url AS url, min(list_append(a.ord, e.position)) AS ord FROM l{k - 1} a JOIN e ON e.src_url = a.url "
                     "WHERE a.url IN (SELECT norm FROM p) AND e.host IN (a.job_id, 'www.' || a.job_id) GROUP BY ALL)")
        parts.append(f"n{k} AS (SELECT c.* FROM c{k} c ANTI JOIN f{k - 1} f ON f.job_id = c.job_id AND f.url = c.url)")
        parts.append(f"l{k} AS (SELECT job_id, url, ord, {k} AS depth FROM (SELECT *, {rank} AS r FROM n{k}) n " + (
            f"WHERE r <= {budget} - (SELECT count(*) FROM f{k - 1} f WHERE f.job_id = n.job_id))" if budget else ")"))
        parts.append(f"f{k} AS (SELECT * FROM f{k - 1} UNION ALL SELECT * FROM l{k})")
    parts.append(f"f AS (SELECT job_id, url, CAST(depth AS INTEGER) AS depth, ord, url IN (SELECT norm FROM p) AS captured FROM f{depth})")
    return "WITH " + ", ".join(parts)


register("crawl_frontier", _frontier_levels(None, 4) + " SELECT job_id, url, depth, array_to_string(ord, '.') AS ord, captured FROM f")(
    lambda spark, d: q_crawl_frontier(spark, d).select("job_id", "url", "depth", F.array_join(F.col("ord"), ".").alias("ord"), "captured"))


def _job_errors(spark, d):
    errors = parse_urls(E.page_errors(_captures(spark, d)), "url", "_e").filter(F.col("_e_host") != "")
    return errors.select(domain_of_host(F.col("_e_host")).alias("job_id"), "phase")


def _summary_sql() -> str:
    errors = O.parse_url_cols(O.Chain(f"SELECT url FROM ({_errors_sql()})", "se"), "url", "_e").sql(
        "SELECT regexp_replace(lower(_e_host), '^www\\.', '') AS job_id FROM {prev} WHERE _e_host <> ''")
    ok = _long_chain().sql("SELECT DISTINCT norm_url AS url FROM {prev}")
    return (_frontier_levels(None, 4) + f", ok AS ({ok}), bad AS ({errors}) "
            "SELECT f.job_id, f.job_id AS domain, count(*) AS pages_discovered, count(*) FILTER (captured) AS pages_visited, "
            "count(*) FILTER (url IN (SELECT url FROM ok)) AS pages_extracted, count(*) FILTER (NOT captured) AS pages_not_captured, "
            "max(depth) AS max_depth_reached, (SELECT count(*) FROM bad WHERE bad.job_id = f.job_id) AS errors FROM f GROUP BY f.job_id")


@register("crawl_summary", _summary_sql())
def q_crawl_summary(spark, d):
    ok = P.manifest_rows(_extracted(spark, d), MIN_WORDS).select("url")
    return FR.crawl_summary(q_crawl_frontier(spark, d), ok, _job_errors(spark, d), _jobs(spark, d))


@register("page_budget", _frontier_levels(5, 2) + " SELECT job_id, url, depth, array_to_string(ord, '.') AS ord FROM f")
def q_page_budget(spark, d):
    """W1/W2 with a small budget: 5 pages per job, two levels."""
    jobs = FR.validate_jobs(DV.derive_jobs(_pages(spark, d), max_pages=5, max_depth=2))
    sm = SM.sitemap_seed_urls(jobs, DV.derive_sitemap_docs(_pages(spark, d)))
    return FR.crawl_frontier(jobs, _norm_links(spark, d), _fetched(spark, d), sm).select(
        "job_id", "url", "depth", F.array_join(F.col("ord"), ".").alias("ord"))


def _page_graph(spark, d):
    """A deep graph over the captured pages: page i links to pages 2i+1, 2i+2
    and back to i/3 (positions 0, 1, 2) where they exist, so it has cycles and
    pages with several parents."""
    p = normalize_urls(_pages(spark, d).select("page_id", "url"), "url", "norm").filter(F.col("norm").isNotNull())
    kids = p.select(F.col("norm").alias("src_url"), F.posexplode(F.array(
        2 * F.col("page_id") + 1, 2 * F.col("page_id") + 2, F.floor(F.col("page_id") / 3))).alias("position", "did"))
    dst = p.select(F.col("page_id").alias("did"), F.col("norm").alias("dst_url"))
    return kids.join(dst, "did").select("src_url", "position", "dst_url"), p


@register("deep_frontier")
def q_deep_frontier(spark, d):
    """O4 on the deep graph: one job seeded at page 0's URL, any host, no page
    or depth limit (BFS to the end)."""
    edges, p = _page_graph(spark, d)
    jobs = p.filter(F.col("page_id") == 0).select(
        F.lit("graph").alias("job_id"), F.lit("").alias("domain"), F.array().cast("array<string>").alias("allowed_domains"),
        F.lit(0).alias("max_pages"), F.lit(0).alias("max_depth"), F.lit("sitemap").alias("discovery_mode"))
    seed = p.filter(F.col("page_id") == 0).select(F.lit("graph").alias("job_id"), F.col("norm").alias("loc"),
                                                  F.array().cast("array<int>").alias("ord"))
    fr = FR.crawl_frontier(jobs, edges, p.select(F.col("norm").alias("url")), seed, scope=FR.any_host)
    return fr.select("url", "depth")


def _deep_sql() -> str:
    c = O.normalize_cols(O.Chain("SELECT page_id, url FROM pages"), "url", "norm")
    c.step("SELECT page_id, norm FROM {prev} WHERE norm IS NOT NULL")
    O.parse_url_cols(c, "norm", "_d")
    c.add({"ok_path": f"NOT {O.is_blacklisted('_d_path')}"})
    return c.sql(
        "SELECT url, CAST(min(depth) AS INTEGER) AS depth FROM ("
        "WITH RECURSIVE nodes AS (SELECT page_id, norm, ok_path FROM {prev}), "
        "edges AS (SELECT a.norm AS src, b.norm AS dst FROM nodes a JOIN nodes b "
        "  ON b.page_id IN (2 * a.page_id + 1, 2 * a.page_id + 2, a.page_id // 3) WHERE b.ok_path), "
        "bfs(url, depth) USING KEY (url) AS (SELECT norm, 1 FROM nodes WHERE page_id = 0 AND ok_path "
        "  UNION SELECT e.dst, min(bfs.depth) + 1 FROM bfs JOIN edges e ON e.src = bfs.url "
        "  WHERE NOT EXISTS (FROM recurring.bfs r WHERE r.url = e.dst) GROUP BY e.dst) "
        "SELECT url, depth FROM bfs) GROUP BY url")


ORACLE["deep_frontier"] = _deep_sql()


# ------------------------------------------------------------------ quality: F13-F16/F18, A8, A10, J6, U17

from webfold.operators import quality as QA  # noqa: E402

_SIG_COLS = ["page_id"] + list(QA.SIGNALS) + ["body_bytes", "signal_score"]


def _signals_sql() -> str:
    flags = ", ".join(f"coalesce({O.rx_like('html', rx)}, false) AS {n}" for n, rx in QA.SIGNALS.items())
    total = " + ".join(f"CAST({n} AS INTEGER)" for n in QA.SIGNALS)
    return (f"SELECT *, CAST({total} AS INTEGER) AS signal_score FROM (SELECT page_id, {flags}, "
            f"CAST(coalesce(octet_length(encode(html)), 0) AS BIGINT) AS body_bytes FROM pages)")


register("html_signals", _signals_sql())(
    lambda spark, d: QA.html_signals(_pages(spark, d)).select(*_SIG_COLS))


def _link_density_sql() -> str:
    c = O.extract_chain("SELECT page_id, url, html FROM pages")
    c.add({"_lt": f"array_to_string(regexp_extract_all(content_html, {O.q(QA.LINK_TEXT)}, 1), ' ')"})
    c.add({"link_chars": f"CAST(length({O.inline_text('_lt')}) AS BIGINT)",
           "text_chars": "CAST(length(text_content) AS BIGINT)"})
    return c.sql("SELECT page_id, link_chars, text_chars, link_chars * 100 <= text_chars * 50 AS link_density_ok FROM {prev}")


register("link_density", _link_density_sql())(
    lambda spark, d: QA.link_density(_extracted(spark, d)).select("page_id", "link_chars", "text_chars", "link_density_ok"))

register("boilerplate_ratio", _extract_sql(
    f"SELECT page_id, CAST(word_count AS BIGINT) AS word_count, "
    f"CAST(len(regexp_extract_all(lower(text_content), {O.q(QA.BOILERPLATE_RX)})) AS BIGINT) AS phrase_hits, "
    f"len(regexp_extract_all(lower(text_content), {O.q(QA.BOILERPLATE_RX)})) * 100 <= word_count * 2 AS boilerplate_ok "
    f"FROM {{prev}}"))(
    lambda spark, d: QA.boilerplate_ratio(_extracted(spark, d)).select("page_id", "word_count", "phrase_hits", "boilerplate_ok"))


def _url_shape_sql() -> str:
    c = O.normalize_cols(O.Chain("SELECT page_id, url FROM pages"), "url", "norm_url")
    c.step("SELECT page_id, norm_url FROM {prev}")
    O.parse_url_cols(c, "norm_url", "_q")
    c.add({"n_query_pairs": "CAST(CASE WHEN _q_query = '' THEN 0 ELSE len(string_split(_q_query, '&')) END AS INTEGER)",
           "is_media": f"coalesce({O.rx_like('_q_path', QA.MEDIA_EXT)}, false)"})
    return c.sql("SELECT page_id, norm_url, n_query_pairs, is_media, n_query_pairs <= 3 AND NOT is_media AS url_ok FROM {prev}")


register("url_shape", _url_shape_sql())(
    lambda spark, d: QA.url_shape(normalize_urls(_pages(spark, d).select("page_id", "url"), "url", "norm_url")))


def _blocks_chain() -> O.Chain:
    pre = O.rx_replace("coalesce(html, '')", T.PRECLEAN, "")
    markup = O.rx_replace(O.rx_replace(pre, T.BLOCK_TAGS, "\n"), T.ANY_TAG, "")
    c = O.Chain(f"SELECT page_id, url, {markup} AS _m FROM pages", "b")
    c.add({"_t": O.rx_replace(O.rx_replace(O.rx_replace(O.decode_entities("_m"), T.HSPACE_RUN, " "), T.NL_RUN, "\n"),
                              T.TRIM_WS, "")})
    O.parse_url_cols(c, "url", "_b")
    c.step("SELECT page_id, _b_host AS host, unnest(string_split(_t, chr(10))) AS block FROM {prev}")
    c.step("SELECT page_id, host, sha256(block) AS block_hash FROM {prev} WHERE block <> ''")
    return c


register("template_blocks", _blocks_chain().sql(
    "SELECT b.host, b.block_hash, b.n_pages, h.host_pages FROM "
    "(SELECT host, block_hash, count(DISTINCT page_id) AS n_pages FROM {prev} GROUP BY host, block_hash) b "
    "JOIN (SELECT host, count(DISTINCT page_id) AS host_pages FROM {prev} GROUP BY host) h ON b.host = h.host "
    "WHERE b.n_pages >= 2 AND b.n_pages * 100 >= h.host_pages * 50"))(
    lambda spark, d: QA.template_blocks(_pages(spark, d)).select("host", "block_hash", "n_pages", "host_pages"))


def _top_quality_sql() -> str:
    total = " + ".join(f"CAST(coalesce({O.rx_like('html', rx)}, false) AS INTEGER)" for rx in QA.SIGNALS.values())
    c = O.extract_chain(f"SELECT page_id, url, html, {total} AS signal_score FROM pages", keep=("page_id", "signal_score"))
    c.add({"_lt": f"array_to_string(regexp_extract_all(content_html, {O.q(QA.LINK_TEXT)}, 1), ' ')"})
    c.add({"_hits": f"len(regexp_extract_all(lower(text_content), {O.q(QA.BOILERPLATE_RX)}))", "_link_chars": f"length({O.inline_text('_lt')})",
           "_chars": "length(text_content)"})
    c.step("SELECT page_id, norm_url, word_count, signal_score, _hits, _link_chars, _chars FROM {prev}")
    O.parse_url_cols(c, "norm_url", "_s")
    c.add({"quality_score": f"CAST(CASE WHEN coalesce(_s_ok AND {O.is_article('_s_path')}, false) THEN 2 ELSE 0 END "
                            "+ CASE WHEN word_count >= 250 THEN 3 ELSE 0 END + signal_score + CASE WHEN _link_chars * 100 <= _chars * 50 THEN 1 ELSE 0 END "
                            "+ CASE WHEN _hits * 100 <= word_count * 2 THEN 1 ELSE 0 END AS INTEGER)"})
    return c.sql("SELECT _s_host AS host, CAST(row_number() OVER (PARTITION BY _s_host ORDER BY quality_score DESC, norm_url, page_id) AS INTEGER) AS host_rank, "
                 "page_id, norm_url, quality_score FROM {prev} QUALIFY host_rank <= 10")


register("top_quality_pages", _top_quality_sql())(lambda spark, d: QA.top_quality_pages(QA.quality_scores(_pages(spark, d))).select(
    "host", "host_rank", "page_id", "norm_url", "quality_score"))

register("canonical_identity", _extract_sql(
    "SELECT page_id, norm_url, identity_url, count(*) OVER (PARTITION BY identity_url) AS n_aliases FROM "
    "(SELECT page_id, norm_url, CASE WHEN canonical_url <> '' THEN canonical_url ELSE norm_url END AS identity_url "
    "FROM {prev} WHERE norm_url IS NOT NULL)"))(
    lambda spark, d: QA.canonical_identity(_extracted(spark, d)).select("page_id", "norm_url", "identity_url", "n_aliases"))

register("page_event_json")(lambda spark, d: QA.page_event_json(_q_crawled(spark, d)))


# ------------------------------------------------------------------ streaming: T1-T6

import uuid as _uuid  # noqa: E402

from webfold.session import scratch_path  # noqa: E402
from webfold.streaming import pipeline as ST  # noqa: E402


def _stream_out(spark, df, name, mode="append"):
    run = f"{name}-{_uuid.uuid4().hex[:12]}"
    sink, ckpt = scratch_path(spark, f"stream/{run}/out"), scratch_path(spark, f"stream/{run}/checkpoint")
    ST.run_available_now(df, sink, ckpt, mode=mode)
    return spark.read.parquet(sink)


def _page_stream(spark, d):
    """The table as a stream, be it one file or a folder of part files: by a pattern, since Spark takes a plain path for a folder."""
    _pages(spark, d)  # no table is an error here; a pattern without matches is none
    return ST.read_page_stream(spark, f"{d}/pages.parque[t]")


@register("stream_manifest", _long_chain().step(
    "SELECT page_id, norm_url, canonical_url, title, word_count, sha256(text_content) AS content_hash FROM {prev}").sql(
    "SELECT norm_url AS url, canonical_url, title, word_count, content_hash FROM {prev}"))
def q_stream_manifest(spark, d):
    stream = _page_stream(spark, d)
    out = _stream_out(spark, ST.stream_manifest(stream, MIN_WORDS), "manifest")
    return out.select("url", "canonical_url", "title", "word_count", "content_hash")


def _timed_pages(spark, d):
    """The page stream with an event time: a minute per page id (the corpus records none)."""
    stream = _page_stream(spark, d)
    ex = E.extract_articles(stream)
    at = F.lit(P.DEFAULT_CRAWLED_AT).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("page_id"))
    return ST.job_of_url(P.crawled_pages(ex, MIN_WORDS, crawled_at=at), "url")


_STREAM_COLS = ["job_id", "url", "crawled_at", "word_count"]


def _deduped(spark, d):
    """T4 over a table of any number of files: event times follow page ids, not the files' order, so no watermark may call a row late."""
    out = scratch_path(spark, f"stream/dedup-{_uuid.uuid4().hex[:12]}")
    ST.run_updates(ST.first_of_keys(_timed_pages(spark, d).select(*_STREAM_COLS)), f"{out}/out", f"{out}/checkpoint")
    return ST.latest(spark, f"{out}/out", ["job_id", "url"])


def _timed_chain() -> O.Chain:
    c = _long_chain()
    c.step("SELECT page_id, norm_url, word_count FROM {prev}")
    O.parse_url_cols(c, "norm_url", "_j")
    return c.step("SELECT regexp_replace(lower(_j_host), '^www\\.', '') AS job_id, norm_url AS url, min(page_id) AS page_id, arg_min(word_count, page_id) AS word_count "
                  "FROM {prev} GROUP BY ALL")


register("stream_dedup", _timed_chain().sql("SELECT job_id, url FROM {prev}"))(
    lambda spark, d: _deduped(spark, d).select("job_id", "url"))


@register("stream_counters", _timed_chain().sql(
    f"SELECT job_id, date_trunc('hour', {CRAWLED_AT_SQL} + to_minutes(page_id)) AS window_start, "
    f"date_trunc('hour', {CRAWLED_AT_SQL} + to_minutes(page_id)) + INTERVAL 1 HOUR AS window_end, count(*) AS pages_extracted, "
    "CAST(sum(word_count) AS BIGINT) AS words FROM {prev} GROUP BY ALL"))
def q_stream_counters(spark, d):
    """T4 then T6 as two streams: deduplicated pages, and their counters per job and hour."""
    run = _uuid.uuid4().hex[:12]
    pages, counts = scratch_path(spark, f"stream/pages-{run}"), scratch_path(spark, f"stream/counts-{run}")
    _deduped(spark, d).select(*_STREAM_COLS).write.parquet(pages)
    stream = spark.readStream.schema("job_id string, url string, crawled_at timestamp, word_count int").parquet(pages)
    ST.run_updates(ST.windowed_counters(stream, delay=None), f"{counts}/out", f"{counts}/checkpoint")
    return ST.latest(spark, f"{counts}/out", ["job_id", "window_start", "window_end"])


# ------------------------------------------------------------------ queries of other modules, registered as they load

from webfold.plans import aliases, captures, deliveries, menus, schedules, sitemap_trees, structure, subtrees, visits  # noqa: E402,F401
