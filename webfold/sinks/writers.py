"""K1/K3/K4/K5/K6/K7: writers (K1 as files: :mod:`webfold.sinks.files`).

All writes are task-side and committed by Spark's output committer (a failed
task's files are discarded), so they survive executor loss.  Paths can be any
Spark-supported file system (``s3a://``, ``gs://``, ``hdfs://`` ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webfold.constants import MANIFEST_COLUMNS
from webfold.functions.text import rfc3339

# fixed values: the wide manifest's columns in order
WIDE_MANIFEST_COLUMNS = ["url", "canonical_url", "relative_path", "title", "byline", "site_name", "word_count", "content_hash", "crawled_at", "status"]
MANIFEST_FORMATS = ("csv", "parquet", "json")


def manifest_format(name: str | None) -> str:
    """K4: pick the manifest writer by name (trimmed, case-insensitive);
    'sqlite' is refused like the reference, anything else is an error."""
    f = (name or "csv").strip().lower()
    if f == "sqlite":
        raise NotImplementedError("sqlite manifest is not implemented; use csv, parquet or json")
    if f not in MANIFEST_FORMATS:
        raise ValueError(f"unsupported manifest type {name!r}")
    return f


def _manifest_strings(manifest: DataFrame) -> DataFrame:
    cols = []
    for c in MANIFEST_COLUMNS:
        v = F.col(c)
        if c == "crawled_at" and dict(manifest.dtypes).get(c) == "timestamp":
            v = rfc3339(v)
        cols.append(v.cast("string").alias(c))
    return manifest.select(*cols)


def write_manifest(manifest: DataFrame, path: str, fmt: str = "csv") -> None:
    """K3/K6: manifest with the fixed column order; CSV with header, RFC 3339
    times, standard quoting (quotes doubled, empty fields bare).  Parquet and
    JSON also hold byline and site name where the rows have them."""
    f = manifest_format(fmt)
    wide = [c for c in WIDE_MANIFEST_COLUMNS if c in manifest.columns] or MANIFEST_COLUMNS
    out = _manifest_strings(manifest) if f == "csv" else manifest.select(*wide)
    w = out.write.mode("overwrite")
    if f == "csv":
        w.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    else:
        w.format(f).save(path)


def write_pages(crawled: DataFrame, path: str, buckets: int = 64) -> None:
    """K1: Markdown documents with their relative path, in folders by a hash
    bucket of the host and sorted by host inside.  The range partitioning by
    (bucket, host, path) splits a big host and keeps the number of files near
    partitions + buckets, however many hosts there are."""
    df = crawled.withColumn("host", F.regexp_extract("relative_path", r"^pages/([^/]+)/", 1))
    df = df.withColumn("bucket", F.pmod(F.xxhash64("host"), F.lit(buckets)).cast("int"))
    (df.repartitionByRange("bucket", "host", "relative_path").sortWithinPartitions("bucket", "host", "relative_path")
     .write.mode("overwrite").partitionBy("bucket").parquet(path))


def write_errors(errors: DataFrame, path: str) -> None:
    """K7: error rows as CSV (same conventions as the manifest): as they are, or whole with job and time
    by :func:`webfold.streaming.delivery.error_rows`."""
    errors.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """K5: the per-job summary as a table."""
    summary.write.mode("overwrite").parquet(path)
