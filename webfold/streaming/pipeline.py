"""The page pipeline on Structured Streaming.

* T1 source: a file stream of captured pages (Parquet or JSON) with a fixed
  schema — or any streaming DataFrame with the same columns (e.g. Kafka
  parsed with ``from_json``).
* T3 the *same* functions as batch: :func:`extract_articles`,
  :func:`crawled_pages` and :func:`manifest_rows` take a streaming DataFrame
  unchanged (all projections and filters; no stateful step inside).
* T4/T5 cross-batch dedup of (job, URL) and of content hashes with
  ``dropDuplicatesWithinWatermark`` — state is bounded by the watermark.
* T6 per-job counters per event-time window, appended once the watermark
  passes the window end (late rows are dropped — our rule).
* T2/T7 ``foreachBatch`` writes pages, manifest and errors; each batch writes
  its own ``batch_id=<n>`` folder in overwrite mode, so a replay after a
  failure rewrites the same files (idempotent), and the checkpoint gives
  redelivery of unacknowledged input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webfold.constants import MANIFEST_COLUMNS, MANIFEST_STATUS_OK
from webfold.operators.extract import capture_gate, extract_articles, page_errors
from webfold.operators.pages import DEFAULT_CRAWLED_AT, crawled_pages, manifest_rows
from webfold.sources.tables import PAGES_SCHEMA
from webfold.functions.urls import domain_of_host, parse_urls


def read_page_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = PAGES_SCHEMA,
                     max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """Captured pages as a stream (fixed schema, no inference).  ``path``
    is a folder, or a pattern of folders and files; ``glob`` picks files in it (e.g. ``pages*.parquet``)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def stream_manifest(pages: DataFrame, min_word_count: int = 250, crawled_at=DEFAULT_CRAWLED_AT) -> DataFrame:
    """The batch manifest functions applied to a stream (no URL dedup:
    that is T4's job across batches)."""
    return manifest_rows(extract_articles(pages), min_word_count, crawled_at, dedup=False)


def dedup_urls_within_watermark(df: DataFrame, delay: str | None = "1 hour", ts: str = "crawled_at",
                                keys: tuple[str, ...] = ("job_id", "url")) -> DataFrame:
    """T4: drop a (job, URL) already seen within the watermark delay
    (``delay=None`` keeps a watermark set upstream)."""
    if delay:
        df = df.withWatermark(ts, delay)
    return df.dropDuplicatesWithinWatermark(list(keys))


def first_of_keys(df: DataFrame, ts: str = "crawled_at", keys: tuple[str, ...] = ("job_id", "url")) -> DataFrame:
    """T4 without a horizon: the row of the earliest event time of each key, in
    whatever order rows arrive (update mode: :func:`run_updates`, then
    :func:`latest`).  Its state is a row per key; no row is late.  Rows without
    a time count only where a key has no other."""
    rest = [c for c in df.columns if c not in (*keys, ts)]
    first = F.min(F.struct(F.col(ts).isNull().alias("untimed"), ts, *rest)).alias("first")
    return df.groupBy(*keys).agg(first).select(*keys, *[F.col(f"first.{c}").alias(c) for c in (ts, *rest)])


def dedup_content_within_watermark(df: DataFrame, delay: str = "1 hour", ts: str = "crawled_at") -> DataFrame:
    """T5: drop a content hash already seen within the watermark delay."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["content_hash"])


def job_of_url(df: DataFrame, url: str = "url", out: str = "job_id") -> DataFrame:
    p = parse_urls(df, url, "_j")
    return p.withColumn(out, domain_of_host(F.col("_j_host"))).drop(*[c for c in p.columns if c.startswith("_j_")])


def windowed_counters(crawled: DataFrame, window: str = "1 hour", delay: str | None = "10 minutes",
                      ts: str = "crawled_at") -> DataFrame:
    """Pages and words per job and event-time window (append mode);
    ``delay=None`` keeps a watermark set upstream (one per stream)."""
    if delay:
        crawled = crawled.withWatermark(ts, delay)
    return (crawled
            .groupBy("job_id", F.window(ts, window).alias("w"))
            .agg(F.count("*").alias("pages_extracted"), F.sum("word_count").alias("words"))
            .select("job_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "pages_extracted", "words"))


def parquet_sink(out_dir: str):
    """The default sink of :func:`batch_writer`: a folder per table and batch, overwritten on a replay."""
    def save(table: str, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{table}/batch_id={batch_id}")
    return save


def batch_writer(out_dir: str, min_word_count: int = 250, crawled_at=DEFAULT_CRAWLED_AT, sink=None, converter=None):
    """``foreachBatch`` function writing pages, manifest, errors and a
    summary of a micro-batch of captured pages; idempotent per ``batch_id``.

    The extraction runs once: the pages are written first and the other tables
    read what was written.  ``sink`` (X2) is a function (table, rows, batch id);
    ``converter`` (X4) goes to :func:`crawled_pages`.
    """
    save = sink or parquet_sink(out_dir)

    def write(batch: DataFrame, batch_id: int) -> None:
        pages = job_of_url(crawled_pages(extract_articles(capture_gate(batch)), min_word_count, crawled_at, converter=converter), "url").persist()
        try:
            save("pages", pages, batch_id)
            save("manifest", pages.select(*[c for c in MANIFEST_COLUMNS if c != "status"], F.lit(MANIFEST_STATUS_OK).alias("status")), batch_id)
            save("errors", page_errors(batch), batch_id)
            save("summary", pages.groupBy("job_id").agg(F.count("*").alias("pages_extracted"), F.sum("word_count").alias("words")), batch_id)
        finally:
            pages.unpersist()
    return write


def run_updates(df: DataFrame, out_dir: str, checkpoint_path: str) -> None:
    """Run an update-mode aggregation to the end of what is available.  Each
    micro-batch overwrites its own folder, so a replay is idempotent; a reader
    takes the newest batch of a key (:func:`latest`), open windows included."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}")
    q = (df.writeStream.outputMode("update").option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).foreachBatch(write).start())
    q.awaitTermination()


def latest(spark: SparkSession, out_dir: str, keys: list[str]) -> DataFrame:
    df = spark.read.parquet(out_dir)
    values = [c for c in df.columns if c not in (*keys, "batch_id")]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("v")).select(*keys, "v.*")


def run_available_now(df: DataFrame, sink_path: str, checkpoint_path: str, mode: str = "append",
                      fmt: str = "parquet") -> None:
    """Process everything available now, then stop (file sink, exactly once)."""
    q = (df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start(sink_path))
    q.awaitTermination()
