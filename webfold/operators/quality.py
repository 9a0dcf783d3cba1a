"""Extraction-quality signals, templates, scoring.

All per-page signals are narrow projections of JVM expressions.  The two
grouping jobs avoid hot-key collapse:

* ``template_blocks`` counts pages per (host, block hash) — the key includes
  the hash, so a host with a third of all pages still spreads over tasks,
  and the counts aggregate partially on the map side;
* ``top_quality_pages`` is a per-host top-k report; the literal k lets Spark
  plan a ``WindowGroupLimit`` before the shuffle, so a hot host sends at most
  k rows per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webfold.constants import BOILERPLATE_PHRASES
from webfold.functions import text as T
from webfold.functions.urls import parse_urls, url_part_columns

# HTML signals of an article page (case-insensitive).
SIGNALS = {
    "has_article": r"(?i)<article\b",
    "has_main": r"(?i)<main\b",
    "og_article": r"""(?is)<meta\b[^>]*\sproperty\s*=\s*["']og:type["'][^>]*\scontent\s*=\s*["']article["']""",
    "schema_article": r"""(?is)"@type"\s*:\s*"(?:News|Blog)?(?:Posting|Article)"|itemtype\s*=\s*["'][^"']*schema\.org/(?:News|Blog)?(?:Posting|Article)""",
    "entry_content": r"""(?is)\sclass\s*=\s*["'][^"']*\b(?:entry-content|post-content|article-body|article-content)\b""",
}
LINK_TEXT = r"(?is)<a\b[^>]*>(.*?)</a\s*>"
MEDIA_EXT = r"(?i)\.(?:jpe?g|png|gif|webp|svg|ico|pdf|mp4|mp3|webm|avi|mov|zip|gz|tar|exe|dmg)$"
BOILERPLATE_RX = "|".join(BOILERPLATE_PHRASES)


def html_signals(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """F13 + F18: signal flags, their sum, and the body size in bytes."""
    cols = [F.coalesce(F.col(html).rlike(rx), F.lit(False)).alias(name) for name, rx in SIGNALS.items()]
    df = pages.select(key, *cols, F.coalesce(F.octet_length(html), F.lit(0)).cast("long").alias("body_bytes"))
    score = sum(F.col(n).cast("int") for n in SIGNALS)
    return df.withColumn("signal_score", score.cast("int"))


def link_density(extracted: DataFrame, key: str = "page_id", max_share_pct: int = 50) -> DataFrame:
    """characters of link text vs all text in the container; passes when
    link text is at most ``max_share_pct`` % of it (integer arithmetic)."""
    links = F.regexp_extract_all(F.col("content_html"), F.lit(LINK_TEXT), 1)
    df = extracted.select(key, F.array_join(links, " ").alias("_lt"),
                          F.length("text_content").cast("long").alias("text_chars"))
    df = df.withColumn("link_chars", F.length(T.inline_text(F.col("_lt"))).cast("long")).drop("_lt")
    return df.withColumn("link_density_ok", F.col("link_chars") * 100 <= F.col("text_chars") * max_share_pct)


def boilerplate_ratio(extracted: DataFrame, key: str = "page_id", max_per_100_words: int = 2) -> DataFrame:
    """boilerplate phrase hits (lowercase text) per 100 words."""
    df = extracted.select(key, F.col("word_count").cast("long").alias("word_count"),
                          F.coalesce(F.regexp_count(F.lower("text_content"), F.lit(BOILERPLATE_RX)), F.lit(0))
                          .cast("long").alias("phrase_hits"))
    return df.withColumn("boilerplate_ok", F.col("phrase_hits") * 100 <= F.col("word_count") * max_per_100_words)


def url_shape(df: DataFrame, url: str = "norm_url", key: str = "page_id", max_query_pairs: int = 3) -> DataFrame:
    """F16: query-heavy and media URLs."""
    p = parse_urls(df.select(key, url), url, "_q")
    n_pairs = F.when(F.col("_q_query") == "", F.lit(0)).otherwise(F.size(F.split(F.col("_q_query"), "&", -1)))
    p = p.select(key, url, n_pairs.cast("int").alias("n_query_pairs"),
                 F.coalesce(F.col("_q_path").rlike(MEDIA_EXT), F.lit(False)).alias("is_media"))
    return p.withColumn("url_ok", (F.col("n_query_pairs") <= max_query_pairs) & ~F.col("is_media"))


def page_blocks(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Text blocks (lines) of the whole page body with their hash, host and
    position; script/style/comments removed first."""
    from webfold.operators.extract import preclean_html
    df = pages.select(key, "url", T.html_to_text_markup(preclean_html(F.col("html"))).alias("_m"))
    df = df.withColumn("_t", T.tidy_text(T.decode_text(F.col("_m")))).drop("_m")
    df = parse_urls(df, "url", "_b").withColumn("host", F.col("_b_host")).drop(*url_part_columns("_b"))
    df = df.select(key, "host", F.posexplode(F.split("_t", "\n", -1)).alias("position", "block"))
    return df.filter(F.col("block") != "").withColumn("block_hash", F.sha2("block", 256))


def template_blocks(pages: DataFrame, key: str = "page_id", min_share_pct: int = 50, min_pages: int = 2) -> DataFrame:
    """Blocks repeated on at least ``min_share_pct`` % (and ``min_pages``)
    of a host's pages: (host, block_hash, n_pages, host_pages).

    The narrow (page, host, block hash) rows are made in one scan of the HTML
    and written once; both counts read them."""
    blocks = page_blocks(pages, key).select(key, "host", "block_hash").distinct().checkpoint()
    per_block = blocks.groupBy("host", "block_hash").agg(F.count("*").alias("n_pages")).filter(F.col("n_pages") >= min_pages)
    per_host = blocks.select(key, "host").distinct().groupBy("host").agg(F.count("*").alias("host_pages"))
    t = per_block.join(per_host, "host")
    return t.filter(F.col("n_pages") * 100 >= F.col("host_pages") * min_share_pct)


def without_template_blocks(pages: DataFrame, key: str = "page_id", **limits) -> DataFrame:
    """A8, second half: (``key``, text) of each page without its host's template blocks."""
    templates = template_blocks(pages, key, **limits).select("host", "block_hash")
    left = page_blocks(pages, key).join(templates, ["host", "block_hash"], "left_anti")
    text = left.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("position", "block"))).alias("b"))
    return text.select(key, F.array_join(F.col("b.block"), "\n").alias("text"))


def quality_scores(pages: DataFrame, key: str = "page_id", min_words: int = 250) -> DataFrame:
    """A10: weighted sum of F4, F6, F13, F14, F15 per page (integer score).

    One narrow map over the pages: all signals are columns of the same row."""
    from webfold.functions.urls import is_article_path
    from webfold.operators.extract import extract_articles
    signals = sum(F.coalesce(F.col("html").rlike(rx), F.lit(False)).cast("int") for rx in SIGNALS.values())
    ex = extract_articles(pages.select(key, "url", "html", signals.alias("signal_score")), keep=(key, "signal_score"))
    links = F.regexp_extract_all(F.col("content_html"), F.lit(LINK_TEXT), 1)
    df = ex.select(key, "norm_url", "word_count", "signal_score", F.array_join(links, " ").alias("_lt"),
                   F.length("text_content").cast("long").alias("_chars"),
                   F.coalesce(F.regexp_count(F.lower("text_content"), F.lit(BOILERPLATE_RX)), F.lit(0)).cast("long").alias("_hits"))
    df = df.withColumn("_link_chars", F.length(T.inline_text(F.col("_lt"))).cast("long")).drop("_lt")
    df = parse_urls(df, "norm_url", "_s")
    article = F.coalesce(F.col("_s_ok") & is_article_path(F.col("_s_path")), F.lit(False))
    score = (article.cast("int") * 2 + (F.col("word_count") >= min_words).cast("int") * 3 + F.col("signal_score")
             + (F.col("_link_chars") * 100 <= F.col("_chars") * 50).cast("int") + (F.col("_hits") * 100 <= F.col("word_count") * 2).cast("int"))
    return df.select(key, "norm_url", F.col("_s_host").alias("host"), score.cast("int").alias("quality_score"))


def top_quality_pages(scores: DataFrame, k: int = 10, key: str = "page_id") -> DataFrame:
    """A10 report: the k best pages per host (score desc, then URL, key)."""
    w = Window.partitionBy("host").orderBy(F.col("quality_score").desc(), F.col("norm_url"), F.col(key))
    return scores.withColumn("host_rank", F.row_number().over(w)).filter(F.col("host_rank") <= F.lit(int(k)))


def chain_ends(hops: DataFrame) -> DataFrame:
    """(url, end) for each ``url`` of ``hops`` (url, to): where following ``to`` ends; on a cycle, its smallest URL.

    Pointer jumping: each round doubles the way that a row has gone, so rounds
    are the logarithm of the longest chain.  A row keeps the smallest URL it has
    passed; rows that never end lead into a cycle, and once the way is as long as there are
    such rows, the place they stand at has passed its whole cycle.  ``url`` is
    unique; of several rows the smallest ``to`` counts.  Rounds are written, and only a
    number a round reaches the driver.
    """
    state = (hops.filter("url IS NOT NULL AND to IS NOT NULL AND url <> to").groupBy("url").agg(F.min("to").alias("at"))
             .select("url", "at", F.col("url").alias("low"), F.lit(False).alias("done")).checkpoint())
    way = 1
    while (left := state.filter("NOT done").count()) and way <= 2 * left:
        ahead = state.select(F.col("url").alias("_u"), F.col("at").alias("_at"), F.col("low").alias("_low"), F.col("done").alias("_done"))
        gone = state.filter("NOT done").join(ahead, F.col("at") == F.col("_u"), "left").select(
            "url", F.coalesce("_at", "at").alias("at"), F.least("low", "_low").alias("low"), F.coalesce("_done", F.lit(True)).alias("done"))
        state = state.filter("done").unionByName(gone).checkpoint()
        way *= 2
    cycle = state.filter("NOT done").select(F.col("url").alias("_u"), F.col("low").alias("_low"))
    around = state.filter("NOT done").join(cycle, F.col("at") == F.col("_u")).select("url", F.col("_low").alias("end"))
    return state.filter("done").select("url", F.col("at").alias("end")).unionByName(around)


def canonical_identity(extracted: DataFrame, key: str = "page_id") -> DataFrame:
    """Identity URL = where the page's canonical links lead: the canonical
    URL it declares, the one declared there if that is a captured page, and so on
    (on a cycle its smallest URL); else its own normalised URL.  ``n_aliases`` = pages
    sharing that identity.  Of several captures of a URL that of the lowest key counts."""
    ident = F.when(F.col("canonical_url") != "", F.col("canonical_url")).otherwise(F.col("norm_url"))
    # written once: the joins read short columns, and their lineage ends here instead of in the extraction
    df = extracted.filter(F.col("norm_url").isNotNull()).select(key, "norm_url", ident.alias("next_url")).checkpoint()
    hops = df.groupBy(F.col("norm_url").alias("url")).agg(F.min_by("next_url", key).alias("to"))
    ends = chain_ends(hops)
    df = (df.join(ends, F.col("next_url") == F.col("url"), "left").drop("url")
          .select(key, "norm_url", F.coalesce("end", "next_url").alias("identity_url")).checkpoint())
    counts = df.groupBy("identity_url").agg(F.count("*").alias("n_aliases"))
    return df.join(counts, "identity_url", "left")


def page_event_json(crawled: DataFrame) -> DataFrame:
    """A whole page event as JSON; empty optional fields are omitted
    (``nullif`` + ``to_json`` drops nulls), timestamps as RFC 3339."""
    opt = ["byline", "site_name", "language", "excerpt"]
    fields = []
    for c in ["job_id", "url", "canonical_url", "title", "byline", "site_name", "language", "published_time",
              "relative_path", "markdown_content", "text_content", "excerpt", "word_count", "content_hash", "http_status", "crawled_at",
              "extraction_method", "content_type"]:
        v = F.col(c)
        if c in ("crawled_at", "published_time"):
            v = T.rfc3339(v)
        if c in opt:
            v = F.nullif(v, F.lit(""))
        fields.append(v.alias(c))
    return crawled.select("page_id", F.to_json(F.struct(*fields)).alias("event_json"))


def summary_event_json(summary: DataFrame) -> DataFrame:
    """A job's summary event."""
    fields = [F.col(c) if c not in ("started_at", "finished_at") else T.rfc3339(F.col(c)).alias(c)
              for c in ("job_id", "domain", "pages_discovered", "pages_visited", "pages_extracted", "errors", "started_at", "finished_at") if c in summary.columns]
    return summary.select("job_id", F.to_json(F.struct(*fields)).alias("event_json"))


def error_event_json(errors: DataFrame, occurred_at) -> DataFrame:
    """An error event; an unknown (null or 0) status is omitted."""
    return errors.select("url", F.to_json(F.struct(*[F.col(c) for c in ("job_id",) if c in errors.columns], F.col("url"),
        F.nullif(F.col("http_status"), F.lit(0)).alias("http_status"), F.col("error"), F.col("phase"),
        T.rfc3339(F.lit(occurred_at).cast("timestamp")).alias("occurred_at"))).alias("event_json"))
