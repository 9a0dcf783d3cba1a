"""Readers for the input tables.

Inputs are Parquet tables; column selection and filters placed after these
readers reach the scan (``ReadSchema`` / ``PushedFilters``), so a query that
needs only ``page_id, url`` never reads ``html``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webfold.constants import (DEFAULT_DISCOVERY_MODE, DEFAULT_MAX_DEPTH, DEFAULT_MAX_PAGES,
                               DEFAULT_MIN_WORD_COUNT)

PAGES_SCHEMA = "page_id bigint, url string, html string"
JOBS_SCHEMA = ("job_id string, domain string, allowed_domains array<string>, max_pages int, max_depth int, "
               "output_format string, discovery_mode string, requested_at timestamp")
SITEMAP_DOCS_SCHEMA = "doc_url string, status int, body string"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Captured pages (``page_id, url, html`` [+ ``status_code``, ``content_type``])."""
    return spark.read.format(fmt).load(path)


def read_jobs(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Crawl jobs with a fixed schema; missing limits take the defaults
    (job row → default), a non-numeric limit keeps the default."""
    raw = spark.read.format(fmt).schema(JOBS_SCHEMA.replace("max_pages int", "max_pages string")
                                        .replace("max_depth int", "max_depth string")).load(path)
    return with_job_defaults(raw)


def with_job_defaults(jobs: DataFrame) -> DataFrame:
    """Fill job parameters: ``coalesce(try_cast(value), default)``."""
    def num(c: str, d: int):
        return F.coalesce(F.col(c).cast("string").try_cast("int"), F.lit(d))

    cols = {
        "max_pages": num("max_pages", DEFAULT_MAX_PAGES),
        "max_depth": num("max_depth", DEFAULT_MAX_DEPTH),
        "discovery_mode": F.lower(F.trim(F.coalesce(F.col("discovery_mode"), F.lit(DEFAULT_DISCOVERY_MODE)))),
    }
    if "min_word_count" in jobs.columns:
        cols["min_word_count"] = num("min_word_count", DEFAULT_MIN_WORD_COUNT)
    return jobs.withColumns(cols)
