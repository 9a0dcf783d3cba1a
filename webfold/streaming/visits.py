"""T4/T5 with bounded state: the first row of each visit to a key, and T6's summary when a job ends.

A visit of a key (a job's URL, a content hash) begins with its earliest row and lasts
``ttl``; rows of the key within it are repeats, the next row after it begins another
visit.  Rows may come in any order: a row waits in state until the watermark has
passed its event time, so that nothing earlier can come, and then a timer decides on it.  A key
leaves the state when its visit has ended and no row waits: what is kept is bounded by
the keys seen within ``ttl`` and the watermark's delay.  State lives in RocksDB
on the executors and is checkpointed with the stream.  Rows behind the
watermark are dropped, by Spark; rows with a null key are not visits.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _ms(us: int) -> int:
    """The first millisecond not before ``us``: the watermark counts in these."""
    return -(-us // 1000)


class FirstOfVisits(StatefulProcessor):
    def __init__(self, keys: tuple[str, ...], schema: StructType, ttl_us: int):
        self.keys, self.schema, self.ttl = keys, schema, ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.schema)  # rows that the watermark has not passed
        self.until = handle.getValueState("until", "us long")  # end of the visit that runs

    def _end(self) -> int | None:
        return self.until.get()[0] if self.until.exists() else None

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        end, new = self._end(), []
        for row in rows:
            if end is None or row["_us"] >= end:
                new.append(tuple(row[c] for c in self.schema.names))
                self.handle.registerTimer(_ms(row["_us"]))
        if new:
            self.waiting.appendList(new)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, end, at = expiredTimerInfo.getExpiryTimeInMs(), self._end(), self.schema.names.index("_us")
        held = sorted((tuple(r) for r in self.waiting.get()), key=lambda r: (r[at], repr(r)))
        later, before = [], end
        for row in held:
            if end is not None and row[at] < end:
                continue
            if _ms(row[at]) > now:
                later.append(row)
            else:
                yield Row(**dict(zip((*self.keys, *self.schema.names), (*key, *row))))
                end = row[at] + self.ttl
        if later:
            self.waiting.put(later)
        else:
            self.waiting.clear()
        if end is not None and _ms(end) <= timerValues.getCurrentWatermarkInMs():
            self.until.clear()
        elif end != before:
            self.until.update((end,))
            self.handle.registerTimer(_ms(end))
        elif end is not None and _ms(end) <= now:
            self.until.clear()

    def close(self) -> None:
        pass


def _having(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows without nulls in ``columns``.  The guard keeps the filter behind the watermark: a row without keys still moves it on."""
    return df.filter(F.when(F.spark_partition_id() >= 0, F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in columns))))


def first_of_visits(df: DataFrame, keys: tuple[str, ...] = ("job_id", "url"), ttl: str = "24 hours", delay: str | None = "1 hour",
                    ts: str = "crawled_at") -> DataFrame:
    """T4 (keys of a visited URL) or T5 (``keys=("content_hash",)``) on a stream, in append mode.

    ``delay=None`` keeps a watermark set upstream.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if delay:
        df = df.withWatermark(ts, delay)
    ttl_us = spark.sql(f"SELECT unix_micros(timestamp'1970-01-01 00:00:00Z' + INTERVAL '{ttl.split()[0]}' {ttl.split()[1].rstrip('s')}) AS us").first().us
    columns = df.columns
    known = _having(df, (*keys, ts)).withColumn("_us", F.unix_micros(ts))
    held = known.drop(*keys, ts)
    out = StructType([known.schema[k] for k in keys] + held.schema.fields)
    seen = known.groupBy(*keys).transformWithState(FirstOfVisits(keys, held.schema, ttl_us), out, "append", "EventTime")
    return seen.withColumn(ts, F.timestamp_micros("_us")).select(*columns)


def with_clock(df: DataFrame, spark: SparkSession, folder: str, at, ts: str = "crawled_at") -> DataFrame:
    """``df`` (a stream) and a row that is null but for the event time ``at``: the end of a finite input.

    It moves the watermark on, so that what waits is decided and what has ended leaves the state.
    """
    empty = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != ts else F.lit(at).cast("timestamp").alias(ts) for f in df.schema.fields]
    spark.range(1).select(*empty).write.mode("overwrite").parquet(folder)
    return df.unionByName(spark.readStream.schema(df.schema).parquet(folder))


def job_summaries(df: DataFrame, gap: str = "1 hour", delay: str | None = "10 minutes", ts: str = "crawled_at") -> DataFrame:
    """One row per job when it has been silent for ``gap``: pages, words, first and last event time.

    A job's session is state until it ends; partial sessions merge before the shuffle's state, so a hot job is a row a task.
    Append mode: a row leaves once the watermark has passed the session's end, and later rows of the job begin another.
    """
    if delay:
        df = df.withWatermark(ts, delay)
    return (_having(df, ("job_id", ts)).groupBy("job_id", F.session_window(ts, gap).alias("s"))
            .agg(F.count("*").alias("pages_extracted"), F.sum("word_count").alias("words"), F.min(ts).alias("started_at"), F.max(ts).alias("finished_at"))
            .select("job_id", "started_at", "finished_at", "pages_extracted", "words"))
