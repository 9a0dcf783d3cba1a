"""Page pipeline from extracted articles to documents.

``crawled_pages`` is the per-page record (the reference's ``CrawledPage``),
``article_manifest`` its 8-column projection.  Both are narrow maps over the
extracted table except the URL dedup, which shuffles only small columns.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from webfold.constants import DEFAULT_MIN_WORD_COUNT, EXTRACTION_METHOD, MANIFEST_STATUS_OK
from webfold.functions import text as T
from webfold.functions.markdown import markdown
from webfold.functions.urls import normalize_urls, relative_paths

# A fixed crawl time keeps runs repeatable; callers pass their own.
DEFAULT_CRAWLED_AT = _dt.datetime(2026, 1, 1, 0, 0, 0)


def _ts(v) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(v).cast("timestamp")


def to_markdown(df: DataFrame, html: str = "content_html", out: str = "markdown", base: str = "norm_url") -> DataFrame:
    """E2 + U11: Markdown of the article container, normalised; links absolute where ``base`` names the page."""
    of = F.col(base) if base in df.columns else F.lit(None).cast("string")
    return df.withColumn(out, T.normalize_markdown(markdown(F.col(html), of)))


def content_hash(text: Column) -> Column:
    """SHA-256 hex of the text content (not of the Markdown)."""
    return F.sha2(text, 256)


def front_matter(url: Column, canonical_url: Column, title: Column, byline: Column, site_name: Column,
                 crawled_at: Column, word_count: Column, content_hash_: Column) -> Column:
    """YAML front matter; canonical_url, byline, site_name only when non-empty."""
    def field(key: str, v: Column) -> Column:
        return F.concat(F.lit(f"{key}: "), T.go_quote(v), F.lit("\n"))

    def optional(key: str, v: Column) -> Column:
        return F.when(F.coalesce(v, F.lit("")) != "", field(key, v)).otherwise(F.lit(""))

    return F.concat(
        F.lit("---\n"),
        field("url", url),
        optional("canonical_url", canonical_url),
        field("title", title),
        optional("byline", byline),
        optional("site_name", site_name),
        field("crawled_at", T.rfc3339(crawled_at)),
        F.lit("word_count: "), word_count.cast("string"), F.lit("\n"),
        field("content_hash", content_hash_),
        F.lit("---\n"),
    )


def dedup_by_url(df: DataFrame, url: str = "norm_url", order: str = "page_id") -> DataFrame:
    """A3 on captured pages: one row per normalised URL (lowest ``order``).

    ``groupBy`` + ``min_by`` aggregates partially on the map side, so a URL
    captured a billion times still leaves each task as one row.
    """
    others = [c for c in df.columns if c not in (url,)]
    agg = df.groupBy(url).agg(F.min_by(F.struct(*others), F.col(order)).alias("_r"))
    return agg.select(url, *[F.col(f"_r.{c}").alias(c) for c in others])


def first_captures(pages: DataFrame, url: str = "url", key: str = "page_id") -> DataFrame:
    """A URL is visited once: of captures with the same normalised URL the one of the lowest ``key`` stays, before
    anything is extracted.  Captures whose URL does not parse stay, as errors of their own.

    Works on (key, URL) alone; only the keys that go meet the pages, and AQE broadcasts them where they are few.
    """
    narrow = normalize_urls(pages.select(key, url), url, "_norm").filter(F.col("_norm").isNotNull()).select(key, "_norm")
    several = narrow.groupBy("_norm").agg(F.min(key).alias("_first"), F.count("*").alias("_n")).filter(F.col("_n") > 1).drop("_n")
    gone = narrow.join(several, "_norm").filter(F.col(key) != F.col("_first")).select(key)
    return pages.join(gone, key, "left_anti")


def crawled_pages(extracted: DataFrame, min_word_count: int = DEFAULT_MIN_WORD_COUNT,
                  crawled_at=DEFAULT_CRAWLED_AT, http_status: Column | None = None,
                  job_id: Column | None = None, converter=None) -> DataFrame:
    """Extracted → F6 → E2 → U11 → U10 → U12 → U14 → ``CrawledPage`` rows.

    ``url`` in the output is the normalised request URL (the reference
    normalises before each request).  Pages whose URL does not normalise are
    left to :func:`webfold.operators.extract.page_errors`.
    """
    df = extracted.filter(F.col("norm_url").isNotNull())
    df = df.filter(F.col("word_count") >= F.lit(int(min_word_count)))
    df = (converter or to_markdown)(df)  # X4: any function that adds a column ``markdown``
    df = relative_paths(df, "norm_url", "relative_path")
    df = df.withColumns({
        "content_hash": content_hash(F.col("text_content")),
        "crawled_at": _ts(crawled_at),
    })
    fm = front_matter(F.col("norm_url"), F.col("canonical_url"), F.col("title"), F.col("byline"),
                      F.col("site_name"), F.col("crawled_at"), F.col("word_count"), F.col("content_hash"))
    df = df.withColumn("markdown_content", F.concat(fm, F.lit("\n"), F.col("markdown"), F.lit("\n")))
    keep = [c for c in extracted.columns if c in ("page_id",)]
    if http_status is None and "status_code" in extracted.columns:
        http_status = F.col("status_code")
    ctype = F.col("content_type") if "content_type" in extracted.columns else F.lit("text/html")
    return df.select(
        *keep,
        (job_id if job_id is not None else F.lit("")).alias("job_id"),
        F.col("norm_url").alias("url"),
        "canonical_url", "title", "byline", "site_name", "language", "published_time",
        "relative_path", "markdown_content", "text_content", "excerpt", "word_count", "content_hash",
        (http_status if http_status is not None else F.lit(200)).cast("int").alias("http_status"),
        "crawled_at",
        F.lit(EXTRACTION_METHOD).alias("extraction_method"),
        ctype.alias("content_type"),
    )


def manifest_rows(extracted: DataFrame, min_word_count: int = DEFAULT_MIN_WORD_COUNT,
                  crawled_at=DEFAULT_CRAWLED_AT, dedup: bool = True) -> DataFrame:
    """K2: the 8-column manifest (url, canonical_url, relative_path, title,
    word_count, content_hash, crawled_at, status='ok').

    Only small columns survive the filter, so the optional URL dedup shuffles
    a few hundred bytes per page, never the HTML or the Markdown.
    """
    df = extracted.filter(F.col("norm_url").isNotNull())
    df = df.filter(F.col("word_count") >= F.lit(int(min_word_count)))
    df = df.select("page_id", "norm_url", "canonical_url", "title", "word_count",
                   content_hash(F.col("text_content")).alias("content_hash"))
    if dedup:
        df = dedup_by_url(df)
    df = relative_paths(df, "norm_url", "relative_path")
    return df.select(
        F.col("norm_url").alias("url"), "canonical_url", "relative_path", "title", "word_count",
        "content_hash", T.rfc3339(_ts(crawled_at)).alias("crawled_at"),
        F.lit(MANIFEST_STATUS_OK).alias("status"),
    )


def path_collisions(manifest: DataFrame) -> DataFrame:
    """Data-quality check: relative paths claimed by more than one URL
    (http/https and ports share a host folder; ``/`` and ``/index`` share
    ``index.md``)."""
    return (manifest.groupBy("relative_path")
            .agg(F.count("*").alias("n_urls"), F.min("url").alias("first_url"), F.max("url").alias("last_url"))
            .filter(F.col("n_urls") > 1))


def content_dedup(df: DataFrame, hash_col: str = "content_hash", key: str = "page_id",
                  prefer: Column | None = None) -> DataFrame:
    """Keep one row per content hash — canonical first, then lowest key.

    One ``groupBy`` with map-side partial aggregation takes the winner's whole
    row, so a hot hash leaves each task as one row, nothing is shuffled twice
    and a key that stands on several rows keeps no loser.  Rows with a null
    hash are one group.
    """
    others = [c for c in df.columns if c != hash_col]
    rank = prefer if prefer is not None else F.lit(0)
    # the other columns come last, so that rows with equal keys are told apart the same way in every run
    order = F.struct(rank.alias("_pref"), F.col(key).alias("_key"), *[F.col(c) for c in others if not isinstance(df.schema[c].dataType, MapType)])
    agg = df.groupBy(hash_col).agg(F.min_by(F.struct(*others), order).alias("_r"))
    return agg.select(*[F.col(hash_col) if c == hash_col else F.col(f"_r.{c}").alias(c) for c in df.columns])

