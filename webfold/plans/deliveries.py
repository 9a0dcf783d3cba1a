"""Delivery of captures with retries: what ends in the dead letters, and the events that were committed."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from webfold.plans import oracle as O
from webfold.plans.catalog import MIN_WORDS, _captures, _errors_sql, _long_chain, _CAPTURES_SQL, register
from webfold.session import scratch_path
from webfold.streaming import delivery as D


def _delivered(spark, d) -> str:
    """All captures once, then what is to be redelivered until nothing is; every batch through the same function."""
    out = scratch_path(spark, f"stream/delivery-{uuid.uuid4().hex[:12]}")
    captures, write = _captures(spark, d), D.deliver(out, MIN_WORDS)
    for batch_id in range(D.MAX_ATTEMPTS):
        write(captures if batch_id == 0 else captures.join(D.to_redeliver(spark, out).select("url"), "url", "left_semi").select(*captures.columns), batch_id)
    return out


def _with_job(sql: str) -> str:
    c = O.parse_url_cols(O.Chain(f"SELECT * FROM ({sql})", "wj"), "url", "_j")
    return c.sql("SELECT *, regexp_replace(lower(_j_host), '^www\\.', '') AS job_id FROM {prev}")


register("dead_letters", f"""
SELECT job_id, url, max(CASE WHEN phase = 'fetch' THEN 3 ELSE 1 END) AS attempts, min((phase, error)).phase AS phase, min((phase, error)).error AS error
FROM ({_with_job(_errors_sql())}) GROUP BY job_id, url""".replace("min((phase, error)).phase", "arg_min(phase, (phase, error))").replace("min((phase, error)).error", "arg_min(error, (phase, error))"))(
    lambda spark, d: D.committed(spark, _delivered(spark, d), "dead_letters").select("job_id", "url", "attempts", "phase", "error"))


def _first_batch_sql() -> str:
    gate = (f"SELECT page_id, url, html FROM ({_CAPTURES_SQL}) WHERE (status_code IS NULL OR status_code BETWEEN 200 AND 299) AND (coalesce(content_type, '') = '' "
            "OR lower(content_type) LIKE '%text/html%' OR lower(content_type) LIKE '%application/xhtml+xml%')")
    c = O.extract_chain(gate)
    pages = c.sql(f"SELECT norm_url AS url FROM {{prev}} WHERE norm_url IS NOT NULL AND word_count >= {MIN_WORDS}")
    return f"""
WITH ok AS (SELECT job_id, count(*) AS pages_extracted FROM ({_with_job(pages)}) GROUP BY job_id),
bad AS (SELECT job_id, count(*) AS errors FROM ({_with_job(_errors_sql())}) GROUP BY job_id)
SELECT job_id, concat('{{"job_id":"', job_id, '","domain":"', job_id, '","pages_extracted":', coalesce(pages_extracted, 0), ',"errors":', coalesce(errors, 0), '}}') AS event_json
FROM ok FULL JOIN bad USING (job_id)"""


register("summary_events", _first_batch_sql())(
    lambda spark, d: D.committed(spark, _delivered(spark, d), "summary_events").filter("batch_id = 0").select("job_id", "event_json"))
