"""Events of a stream committed together, retries counted, dead letters written once.

Every micro-batch writes its tables (pages, page, error and summary events,
errors, attempts, dead letters) to folders of its own, ``<table>/batch_id=<n>``,
and last a row in the ledger, ``_ledger/batch_id=<n>``.  Readers take only batches that the
ledger names (:func:`committed`), so they see all tables of a batch or none.
A batch that is replayed after a crash, wherever it stopped, starts from the
last committed state before it and overwrites its own folders: the same rows once.

A message is a captured page, known by its URL.  One that can't be fetched may get better
and is delivered again, up to ``max_attempts`` times; other failures are final.  The
attempts of messages that failed and were not acknowledged since are state, carried from batch to batch; a
message that is given up goes to the dead letters once, however often it comes again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webfold.functions.urls import normalize_urls
from webfold.operators.extract import capture_gate, extract_articles, page_errors
from webfold.operators.pages import DEFAULT_CRAWLED_AT, crawled_pages
from webfold.operators.quality import error_event_json, page_event_json, summary_event_json
from webfold.streaming.pipeline import job_of_url

MAX_ATTEMPTS = 3
RETRIED = ("fetch",)  # phases whose failures may be gone at the next attempt
ATTEMPTS = "url string, attempts int, dead boolean"


def _no_attempts(spark: SparkSession) -> DataFrame:
    """The state before any batch.  Rows of a Python list would be read by Python workers of their own, which stay beside those of the functions."""
    return spark.range(0).select(F.lit(None).cast("string").alias("url"), F.lit(None).cast("int").alias("attempts"), F.lit(None).cast("boolean").alias("dead"))


def error_rows(errors: DataFrame, occurred_at) -> DataFrame:
    """K7: whole error rows, with the job of the URL and the time: job_id, url, http_status, error, phase, occurred_at."""
    return job_of_url(errors, "url").select("job_id", "url", "http_status", "error", "phase", F.lit(occurred_at).cast("timestamp").alias("occurred_at"))


def _path(out_dir: str, table: str, batch_id: int | None = None) -> str:
    return f"{out_dir.rstrip('/')}/{table}" + ("" if batch_id is None else f"/batch_id={batch_id}")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def committed_batches(spark: SparkSession, out_dir: str) -> list[int]:
    """Numbers of the committed batches, ascending (a number a batch)."""
    if not _exists(spark, _path(out_dir, "_ledger")):
        return []
    return sorted(r.batch_id for r in spark.read.schema("tables string, batch_id long").parquet(_path(out_dir, "_ledger")).select("batch_id").collect())


def committed(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    """Rows of all committed batches of a table, with their batch_id."""
    done = committed_batches(spark, out_dir)
    rows = spark.read.parquet(_path(out_dir, table))
    return rows.filter(F.col("batch_id").isin(done) if done else F.lit(False))  # folders of other batches are not read


def next_attempts(before: DataFrame, failed: DataFrame, acked: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """The retry state machine: (url, attempts, dead, was_dead, phase, error, http_status) after a batch.

    ``before``: (url, attempts, dead).  ``failed``: error rows of the batch, any number a URL: one attempt.
    ``acked``: URLs that went well: they leave the state.
    """
    tries = failed.filter("url IS NOT NULL").groupBy("url").agg(F.min(F.struct("phase", "error", "http_status")).alias("why"))
    both = before.withColumnRenamed("dead", "was_dead").join(tries, "url", "full").join(acked.select("url").distinct(), "url", "left_anti")
    n = F.coalesce("attempts", F.lit(0)) + F.col("why").isNotNull().cast("int")
    final = F.col("why").isNotNull() & ~F.col("why.phase").isin(*RETRIED)
    was = F.coalesce("was_dead", F.lit(False))
    return both.select("url", n.alias("attempts"), (was | (n >= max_attempts) | F.coalesce(final, F.lit(False))).alias("dead"), was.alias("was_dead"), "why.phase", "why.error", "why.http_status")


def deliver(out_dir: str, min_word_count: int = 250, crawled_at=DEFAULT_CRAWLED_AT, max_attempts: int = MAX_ATTEMPTS, sink=None, converter=None):
    """A ``foreachBatch`` function for micro-batches of captured pages.

    ``sink`` (X2) is a function (table, rows, batch id) used in place of the Parquet folders for all but the state.
    """
    def put(table: str, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(_path(out_dir, table, batch_id))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, send = batch.sparkSession, sink or put
        if batch_id in (done := committed_batches(spark, out_dir)):
            return  # delivered whole already
        last = max((b for b in done if b < batch_id), default=None)
        before = _no_attempts(spark) if last is None else spark.read.schema(ATTEMPTS).parquet(_path(out_dir, "attempts", last))
        pages = job_of_url(crawled_pages(extract_articles(capture_gate(batch)), min_word_count, crawled_at, converter=converter), "url").persist()
        errors = error_rows(page_errors(batch), crawled_at).persist()
        try:
            good = normalize_urls(capture_gate(batch).filter(F.col("html").isNotNull()).select("url"), "url", "_norm").filter("_norm IS NOT NULL").select("url")
            state = next_attempts(before, errors, good.join(errors, "url", "left_anti"), max_attempts).persist()
            send("pages", pages, batch_id)
            send("page_events", page_event_json(pages), batch_id)
            send("errors", errors, batch_id)
            send("error_events", error_event_json(errors, crawled_at), batch_id)
            summary = (pages.groupBy("job_id").agg(F.count("*").alias("pages_extracted"))
                       .join(errors.groupBy("job_id").agg(F.count("*").alias("errors")), "job_id", "full").na.fill(0)
                       .withColumn("domain", F.col("job_id")))
            send("summary_events", summary_event_json(summary), batch_id)
            send("dead_letters", job_of_url(state.filter("dead AND NOT was_dead"), "url").select("job_id", "url", "attempts", "phase", "error", "http_status"), batch_id)
            put("attempts", state.select("url", "attempts", "dead"), batch_id)
            state.unpersist()
        finally:
            pages.unpersist()
            errors.unpersist()
        put("_ledger", spark.range(0, 1, 1, 1).select(F.lit("pages,page_events,errors,error_events,summary_events,dead_letters,attempts").alias("tables")), batch_id)
    return write


def to_redeliver(spark: SparkSession, out_dir: str) -> DataFrame:
    """URLs that were not acknowledged and are not given up, after the last committed batch."""
    done = committed_batches(spark, out_dir)
    if not done:
        return _no_attempts(spark).select("url", "attempts")
    return spark.read.schema(ATTEMPTS).parquet(_path(out_dir, "attempts", done[-1])).filter("NOT dead").select("url", "attempts")
