"""Stream queries with bounded state: visits of URLs and of contents, and the summary of each job."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from webfold.operators import pages as P
from webfold.plans import oracle as O
from webfold.plans.catalog import CRAWLED_AT_SQL, MIN_WORDS, _long_chain, _page_stream, register
from webfold.operators import extract as E
from webfold.session import scratch_path
from webfold.streaming import pipeline as ST
from webfold.streaming import visits as V

TTL_MINUTES = 120
GAP_MINUTES = 45


def _events(spark, d):
    """The page stream with an event time: a minute per page id (the corpus records none)."""
    ex = E.long_articles(E.extract_articles(_page_stream(spark, d)), MIN_WORDS).filter("norm_url IS NOT NULL")
    at = F.lit(P.DEFAULT_CRAWLED_AT).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("page_id"))
    return ST.job_of_url(ex.select(F.col("norm_url").alias("url"), "word_count", P.content_hash(F.col("text_content")).alias("content_hash"),
                                   at.alias("crawled_at")), "url")


def _run(spark, d, name, make):
    """Run ``make`` over the stream and the end of its input; files come in no order of time, so the delay covers the table."""
    root = scratch_path(spark, f"stream/{name}-{uuid.uuid4().hex[:12]}")
    events = V.with_clock(_events(spark, d), spark, f"{root}/clock", "9999-01-01 00:00:00")
    ST.run_available_now(make(events), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


_DELAY = "100 years"


def _events_sql() -> str:
    c = _long_chain()
    c.step(f"SELECT norm_url AS url, word_count, sha256(text_content) AS content_hash, {CRAWLED_AT_SQL} + to_minutes(page_id) AS t FROM {{prev}}")
    O.parse_url_cols(c, "url", "_j")
    return c.sql("SELECT regexp_replace(lower(_j_host), '^www\\.', '') AS job_id, url, word_count, content_hash, t FROM {prev}")


def _visits_sql(keys: str) -> str:
    return (f"WITH RECURSIVE ev AS MATERIALIZED ({_events_sql()}), "
            f"v AS (SELECT {keys}, min(t) AS t FROM ev GROUP BY {keys} UNION ALL "
            f"SELECT {keys}, min(ev.t) FROM v JOIN ev USING ({keys}) WHERE ev.t >= v.t + INTERVAL {TTL_MINUTES} MINUTE GROUP BY {keys}) "
            f"SELECT {keys}, t AS crawled_at FROM v")


register("stream_url_visits", _visits_sql("job_id, url"))(
    lambda spark, d: _run(spark, d, "url-visits", lambda e: V.first_of_visits(
        e.select("job_id", "url", "crawled_at"), ("job_id", "url"), f"{TTL_MINUTES} minutes", _DELAY)))

register("stream_content_visits", _visits_sql("content_hash"))(
    lambda spark, d: _run(spark, d, "content-visits", lambda e: V.first_of_visits(
        e.select("content_hash", "crawled_at"), ("content_hash",), f"{TTL_MINUTES} minutes", _DELAY)))

register("stream_job_summary", f"""
WITH ev AS ({_events_sql()}),
m AS (SELECT *, coalesce(t > lag(t) OVER (PARTITION BY job_id ORDER BY t) + INTERVAL {GAP_MINUTES} MINUTE, true) AS begins FROM ev),
s AS (SELECT *, sum(CAST(begins AS INTEGER)) OVER (PARTITION BY job_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS session FROM m)
SELECT job_id, min(t) AS started_at, max(t) AS finished_at, count(*) AS pages_extracted, CAST(sum(word_count) AS BIGINT) AS words
FROM s GROUP BY job_id, session""")(
    lambda spark, d: _run(spark, d, "job-summary", lambda e: V.job_summaries(e, f"{GAP_MINUTES} minutes", _DELAY)))
