"""Visits and job summaries on streams: rows in any order, late rows, state that shrinks."""
import random

from pyspark.sql import functions as F

from webfold.streaming import visits as V

SCHEMA = "job_id string, url string, crawled_at timestamp, word_count int"


def minutes(spark, rows):
    """rows: (job, url, minute, words)"""
    df = spark.createDataFrame(rows, "job_id string, url string, m long, word_count int")
    return df.select("job_id", "url", F.timestamp_seconds(F.col("m") * 60).alias("crawled_at"), "word_count")


def run(spark, tmp_path, files, make, clock):
    """Each list of ``files`` is a file and a micro-batch, in that order, the last moves the clock; returns rows and the batches' progress."""
    for k, rows in enumerate([*files, [(None, None, clock, None)]]):
        minutes(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{k:03}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    q = make(stream).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out")
    q.awaitTermination()
    return spark.read.parquet(f"{tmp_path}/out"), [p for p in q.recentProgress if p["stateOperators"]]


def greedy(rows, ttl):
    out, end = [], {}
    for job, url, m, _ in sorted(rows, key=lambda r: r[2]):
        if m >= end.get((job, url), -1):
            out.append((job, url, m))
            end[job, url] = m + ttl
    return sorted(out)


def as_minutes(df):
    return sorted((r.job_id, r.url, r.m) for r in df.select("job_id", "url", (F.unix_seconds("crawled_at") / 60).cast("long").alias("m")).collect())


def test_visits_as_in_order_though_rows_come_in_any(spark, tmp_path):
    rnd = random.Random(2)
    rows = [("j", f"u{rnd.randint(0, 3)}", m, 1) for m in rnd.sample(range(400), 60)]
    late = [("j", "u0", 1000, 1), ("j", "u0", 1010, 1)]
    files = [rows[k::3] for k in range(3)] + [late]
    got, progress = run(spark, tmp_path, files, lambda s: V.first_of_visits(s, ttl="30 minutes", delay="500 minutes"), clock=100_000)
    assert as_minutes(got) == greedy(rows + late, 30)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert max(held) > 0 and held[-1] == 0  # all visits have ended


def test_rows_behind_the_watermark_are_dropped_and_expired_keys_come_again(spark, tmp_path):
    files = [[("j", "a", 10, 1)], [("j", "b", 500, 1)], [("j", "a", 12, 1), ("j", "a", 520, 1)], [("j", "c", 900, 1)]]
    got, _ = run(spark, tmp_path, files, lambda s: V.first_of_visits(s, ttl="60 minutes", delay="5 minutes"), clock=100_000)
    assert as_minutes(got) == [("j", "a", 10), ("j", "a", 520), ("j", "b", 500), ("j", "c", 900)]


def test_a_row_a_job_after_its_gap(spark, tmp_path):
    files = [[("j", "a", 0, 5), ("k", "x", 3, 1)], [("j", "b", 20, 7)], [("j", "c", 200, 1)], [("k", "w", 205, 4)], [("j", "late", 21, 100)], [("k", "y", 900, 2)]]
    got, _ = run(spark, tmp_path, files, lambda s: V.job_summaries(s, "30 minutes", "10 minutes"), clock=100_000)
    rows = sorted((r.job_id, r.pages_extracted, r.words, r.started_at.minute) for r in got.collect())
    assert rows == [("j", 1, 1, 20), ("j", 2, 12, 0), ("k", 1, 1, 3), ("k", 1, 2, 0), ("k", 1, 4, 25)]
