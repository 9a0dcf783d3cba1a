"""Main-content extraction from captured pages.

The whole job is a narrow map (no shuffle).  The main content is cut out by a
stack of open elements in one pass over Arrow batches; every other step is a
projection of JVM expressions.  ``html`` is dropped as soon as that is done.

Extraction rule (ours; parity with the reference is its contract: title,
text, word count, excerpt, metadata):

1. pre-clean: drop comments, ``script``, ``style``, ``noscript``, ``iframe``,
   ``template``, and elements whose id or class names a cookie or consent banner (E4);
2. container: all outermost ``<article>`` elements (what stands between them is left
   out), else ``<main>``, else the block with the most prose (words outside links);
   without ``nav``/``footer``/``aside``/``form``, however nested;
3. text: block tags → line breaks, other tags dropped, entities decoded,
   whitespace tidied; word count = Unicode-whitespace fields;
4. title: ``<title>``, else the first ``<h1>`` of the container; excerpt:
   first paragraph; language: ``<html lang>``; byline: ``meta[name=author]``
   or a ``rel=author`` / ``class~=byline|author`` element; site name:
   ``og:site_name``; published time: ``article:published_time``; canonical:
   ``link[rel=canonical]`` resolved and normalised.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from webfold.constants import HTML_CONTENT_TYPES
from webfold.functions import text as T
from webfold.functions.batches import strings
from webfold.functions.dom import main_content
from webfold.functions.urls import normalize_urls, resolve_urls

HEAD = r"(?is)<head\b[^>]*>(.*?)</head\s*>"


def is_html_content_type(ct: Column) -> Column:
    """missing/empty header passes; otherwise it must name an HTML type."""
    rx = "|".join(t.replace("+", r"\+") for t in HTML_CONTENT_TYPES)
    return ct.isNull() | (ct == "") | F.lower(ct).rlike(rx)


def capture_gate(pages: DataFrame) -> DataFrame:
    """F5 and the status rule before any extraction: keep captures with a 2xx or
    unknown ``status_code`` and an HTML or unknown ``content_type``."""
    if "status_code" in pages.columns:
        pages = pages.filter(F.col("status_code").isNull() | F.col("status_code").between(200, 299))
    if "content_type" in pages.columns:
        pages = pages.filter(is_html_content_type(F.col("content_type")))
    return pages


def preclean_html(html: Column) -> Column:
    """Remove comments and non-text elements."""
    return F.regexp_replace(F.coalesce(html, F.lit("")), T.PRECLEAN, "")


def _attr_value(tag: Column, attr_rx: str) -> Column:
    return T.trim_ws(T.decode_entities(T.quoted_attr_value(F.regexp_extract(tag, attr_rx, 1))))


def main_markup(html: Column) -> Column:
    """The main content's markup, by a stack of open elements (slices of Arrow batches)."""
    def many(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return strings(main_content, ((p,) for p in pages))
    # not inlined into what reads it, so a page is read once
    return F.arrow_udf(many, StringType()).asNondeterministic()(html)


def extract_articles(pages: DataFrame, url_col: str = "url", html_col: str = "html",
                     keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """One output row per input page with the extracted fields.

    Output columns: ``keep`` + ``url`` (as captured), ``norm_url``,
    ``title``, ``byline``, ``site_name``, ``language``, ``published_time``,
    ``canonical_url``, ``content_html``, ``text_content``, ``excerpt``,
    ``word_count``.
    """
    df = pages.select(*keep, F.col(url_col).alias("url"), F.col(html_col).alias("_html"))
    df = normalize_urls(df, "url", "norm_url")
    df = df.withColumn("_clean", preclean_html(F.col("_html")))
    c = F.col("_clean")
    df = df.withColumns({
        "_head": F.regexp_extract(c, HEAD, 1),
        "_title_raw": F.regexp_extract(c, T.TITLE, 1),
        "language": F.regexp_extract(c, T.HTML_LANG, 1),
        "_byline_el": F.regexp_extract(c, T.BYLINE_ELEM, 1),
    })
    head = F.when(F.col("_head") != "", F.col("_head")).otherwise(c)
    df = df.withColumn("_headc", head)
    h = F.col("_headc")
    df = df.withColumns({
        "_m_author": F.regexp_extract(h, T.meta_content_rx("name", "author"), 1),
        "_m_site": F.regexp_extract(h, T.meta_content_rx("property", "og:site_name"), 1),
        "_m_pub": F.regexp_extract(h, T.meta_content_rx("property", "article:published_time"), 1),
        "_canon_tag": F.regexp_extract(h, T.CANONICAL_LINK, 1),
    })
    df = df.withColumn("content_html", main_markup(F.col("_html"))).drop("_html", "_clean", "_head", "_headc")
    ch = F.col("content_html")
    cols = {
        "_t1": T.html_to_text_markup(ch),
        "_h1": F.regexp_extract(ch, T.H1, 1),
        "_p1": F.regexp_extract(ch, T.FIRST_P, 1),
    }
    df = df.withColumns(cols)
    title = T.inline_text(F.col("_title_raw"))
    df = df.withColumn("_title", title)
    canon_href = _attr_value(F.col("_canon_tag"), T.HREF_ATTR)
    cols = {
        "text_content": T.tidy_text(T.decode_text(F.col("_t1"))),
        "title": F.when(F.col("_title") != "", F.col("_title")).otherwise(T.inline_text(F.col("_h1"))),
        "excerpt": T.inline_text(F.col("_p1")),
        "byline": F.when(
            F.col("_m_author") != "", _attr_value(F.col("_m_author"), T.CONTENT_ATTR)
        ).otherwise(T.inline_text(F.col("_byline_el"))),
        "site_name": _attr_value(F.col("_m_site"), T.CONTENT_ATTR),
        "published_time": F.try_to_timestamp(_attr_value(F.col("_m_pub"), T.CONTENT_ATTR)),
        "_canon_href": canon_href,
    }
    df = df.withColumns(cols)
    # The guard makes this projection non-deterministic, so Catalyst cannot
    # push a later filter on word_count (or on anything computed above) below
    # it by inlining -- which would run the whole extraction twice.
    df = df.withColumn("word_count", F.when(F.spark_partition_id() >= 0, T.word_count(F.col("text_content"))))
    # canonical link: resolve against the page URL, then normalise
    df = resolve_urls(df, "norm_url", "_canon_href", "_canon_abs")
    df = normalize_urls(df, "_canon_abs", "_canon_norm")
    df = df.withColumn(
        "canonical_url",
        F.when(F.col("_canon_href") != "", F.coalesce(F.col("_canon_norm"), F.lit(""))).otherwise(F.lit("")),
    )
    out = list(keep) + ["url", "norm_url", "title", "byline", "site_name", "language", "published_time",
                        "canonical_url", "content_html", "text_content", "excerpt", "word_count"]
    return df.select(*out)


def long_articles(extracted: DataFrame, min_word_count: int | Column = 250) -> DataFrame:
    """keep rows with ``word_count >= min_word_count`` (equal passes)."""
    m = min_word_count if isinstance(min_word_count, Column) else F.lit(int(min_word_count))
    return extracted.filter(F.col("word_count") >= m)


def page_errors(pages: DataFrame, extracted: DataFrame | None = None, url_col: str = "url",
                html_col: str = "html", key: str = "page_id") -> DataFrame:
    """rows that fail, as an ``errors`` table (``key``, url, http_status,
    error, phase).  Phases: ``normalize`` (URL does not parse), ``fetch``
    (status not 2xx or body missing), ``filter`` (content type not HTML),
    ``extract`` (nothing readable), ``save`` (no host for a path).

    Reads only small columns plus a null/markup test on ``html``.
    """
    cols = pages.columns
    status = F.col("status_code") if "status_code" in cols else F.lit(None).cast("int")
    ctype = F.col("content_type") if "content_type" in cols else F.lit(None).cast("string")
    df = pages.select(
        F.col(key), F.col(url_col).alias("url"), status.alias("http_status"), ctype.alias("content_type"),
        F.col(html_col).isNull().alias("_no_body"),
        F.coalesce(F.col(html_col).rlike(r"<[A-Za-z!/]"), F.lit(False)).alias("_has_markup"),
    )
    df = normalize_urls(df, "url", "_norm", keep_parts="_u")
    err = (
        F.when(F.col("_norm").isNull(), F.struct(F.lit("normalize").alias("phase"), F.lit("invalid page URL").alias("error")))
        .when(F.col("http_status").isNotNull() & ((F.col("http_status") < 200) | (F.col("http_status") > 299)),
              F.struct(F.lit("fetch").alias("phase"), F.concat(F.lit("http status "), F.col("http_status").cast("string")).alias("error")))
        .when(F.col("_no_body"), F.struct(F.lit("fetch").alias("phase"), F.lit("empty body").alias("error")))
        .when(~is_html_content_type(F.col("content_type")),
              F.struct(F.lit("filter").alias("phase"), F.concat(F.lit("not html: "), F.col("content_type")).alias("error")))
        .when(~F.col("_has_markup"), F.struct(F.lit("extract").alias("phase"), F.lit("no markup to extract").alias("error")))
        .when(F.col("_u_host") == "", F.struct(F.lit("save").alias("phase"), F.lit("path generation: URL has no host").alias("error")))
    )
    df = df.withColumn("_err", err).filter(F.col("_err").isNotNull())
    return df.select(F.col(key), "url", "http_status", F.col("_err.error").alias("error"), F.col("_err.phase").alias("phase"))
