"""Exact duplicates with a heavy-hitter split.

One pass digests every text (SHA-256, JVM) into a narrow table.  A Misra-Gries
summary of at most ``counters`` digests per partition finds the digests that
may be frequent.  Summaries merge by summing: the sum undercounts a digest by
at most n/(counters+1), so each digest with at least 2n/(counters+1) rows
passes the threshold, and at most ``counters`` + 1 digests can.  Their exact
size and winner come from one aggregation with map-side combine and are
broadcast (a proven bound), so frequent rows are decided where they lie.
Every other digest has under 2n/(counters+1) rows and is shuffled by digest
as usual.

Defined results: null text counts as empty; of equal texts the largest doc_id
stays (null below all; a group of null ids has a null keep_id and one kept
row); a row repeated whole, id included, is a copy like any other, and one of
the repeats stays.  An empty table gives an empty result.  Only ``id_col`` and
``text_col`` are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

COUNTERS = 1023


def misra_gries(digests: np.ndarray, counts: np.ndarray, counters: int) -> tuple[np.ndarray, np.ndarray]:
    """Reduce a summary to ``counters`` entries: subtract the next largest count, drop what is left empty."""
    if len(counts) <= counters:
        return digests, counts
    counts = counts - np.partition(counts, len(counts) - counters - 1)[len(counts) - counters - 1]
    return digests[counts > 0], counts[counts > 0]


def _summaries(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, counts = np.empty(0, "S32"), np.empty(0, np.int64)
        for batch in batches:
            # "S" drops trailing zero bytes of a digest; it is restored when the summary leaves
            new = np.array(batch.column(0).to_pylist(), "S32")
            digests, at = np.unique(np.concatenate([digests, new]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, np.ones(len(new), np.int64)]), len(digests)).astype(np.int64)
            digests, counts = misra_gries(digests, counts, counters)
        yield pa.RecordBatch.from_pydict(
            {"digest": pa.array([d.ljust(32, b"\0") for d in digests.tolist()], pa.binary()), "n": pa.array(counts, pa.int64())})
    return run


def heavy_digests(digested: DataFrame, rows: int, counters: int = COUNTERS) -> DataFrame:
    """(digest, size, last): frequent digests with exact size and winner; at most ``counters`` + 1 rows."""
    found = (digested.select("digest").mapInArrow(_summaries(counters), "digest binary, n bigint")
             .groupBy("digest").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= max(2.0, rows / (counters + 1))).select("digest"))
    return (digested.join(F.broadcast(found), "digest")
            .groupBy("digest").agg(F.count("*").alias("size"), F.max(F.struct("doc_id", "row")).alias("last")))


def _digested(docs: DataFrame, id_col: str, text_col: str, counters: int) -> tuple[DataFrame, DataFrame]:
    """The narrow digest table, and its heavy digests."""
    digested = cut(docs.select(
        F.col(id_col).alias("doc_id"), _digest(F.col(text_col)).alias("digest"), F.monotonically_increasing_id().alias("row")))
    return digested, cut(heavy_digests(digested, digested.count(), counters))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _light_winners(digested: DataFrame, heavy: DataFrame) -> DataFrame:
    """The rows of digests that are not heavy, with group size and winner."""
    same = Window.partitionBy("digest")
    return (digested.join(F.broadcast(heavy), "digest", "left_anti")
            .withColumn("size", F.count("*").over(same))
            .withColumn("last", F.max(F.struct("doc_id", "row")).over(same)))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """A row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    digested, heavy = _digested(docs, id_col, text_col, counters)
    columns = [
        F.col("doc_id"), F.col("last.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("row") == F.col("last.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")]
    return digested.join(F.broadcast(heavy), "digest").select(*columns).unionByName(_light_winners(digested, heavy).select(*columns))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with all their columns.

    Copies of heavy texts go where they lie, by the broadcast winners.  The rest
    is shuffled once, by digest, and joined to the winner of its text; one of
    several rows with that id and text stays.
    """
    digested, heavy = _digested(docs, id_col, text_col, counters)
    winner = F.col("last.doc_id").alias("keep")
    kept = (heavy.select("digest", winner).unionByName(
        _light_winners(digested, heavy).where("row = last.row").select("digest", winner))).withColumnRenamed("digest", "of")
    named = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("whole"), docs[id_col].alias("id"), _digest(docs[text_col]).alias("digest"))
    left = (named.join(F.broadcast(heavy.select("digest", winner, F.lit(True).alias("heavy"))), "digest", "left")
            .where(F.col("heavy").isNull() | F.col("id").eqNullSafe(F.col("keep"))).select("whole", "id", "digest"))
    # the ids' equality is no join key, so that the one exchange is by digest
    is_winner = (F.col("id") == F.col("keep")) | (F.col("id").isNull() & F.col("keep").isNull())
    joined = left.join(kept, (F.col("digest") == F.col("of")) & is_winner, "left_semi")
    one = Window.partitionBy("digest").orderBy(F.lit(1))
    return joined.withColumn("nth", F.row_number().over(one)).where("nth = 1").select("whole.*")
