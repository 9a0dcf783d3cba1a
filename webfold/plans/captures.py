"""Pages of a crawl in which a URL is visited once: each URL's first capture is picked before extraction."""

from __future__ import annotations

from webfold.operators import extract as E
from webfold.operators import pages as P
from webfold.plans import oracle as O
from webfold.plans.catalog import MIN_WORDS, _pages, register


def _sql() -> str:
    c = O.extract_chain("SELECT page_id, url, html FROM pages")
    c.step("SELECT * FROM {prev} WHERE norm_url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY norm_url ORDER BY page_id) = 1")
    return c.sql(f"SELECT page_id, norm_url AS url, word_count, sha256(text_content) AS content_hash FROM {{prev}} WHERE word_count >= {MIN_WORDS}")


register("crawled_once", _sql())(
    lambda spark, d: P.crawled_pages(E.extract_articles(P.first_captures(_pages(spark, d))), MIN_WORDS).select("page_id", "url", "word_count", "content_hash"))
