"""Periodic runs of words, found by string synchronising sets.

A run is a maximal stretch of words with smallest period q and at least
``EXPONENT`` * q words.  For each dyadic scale t = 1, 2, 4, ... a synchronising
set is chosen: position i belongs to it if the smallest hash among the blocks of t words that
begin at i .. i + t is that of block i or of block i + t.  Membership depends on
the 2t words from i alone (its context), so equal contexts are members together;
and of any t neighbouring positions one is a member.  A run of period
t <= q < 2t with four periods holds a member s whose context lies in the run
together with the equal context at s + q, and no equal context between, as
2t > q.  So neighbouring members with equal contexts propose all periods of the
scale.  Proposals are extended over equal words as far as they go, which is
also the exact check.

Blocks that lie in a run of period at most t / 4 are left out of the choice,
which keeps the sets small.  They are known when scale t begins: such a run
has four periods in the block and came out of a smaller scale.  What the
omission loses at scale t are members within those regions, whose periods are below
t and belong to smaller scales.

Documents are handled many at a time: a task joins the words of a batch with a
unique mark between documents, which no run can hold, and works on arrays.
Scale t only looks at documents of at least 4t words, so the work is about
n log n words, whatever the text.  A document is whole within one batch.  The
64-bit hashes of two different contexts of a batch would have to be equal for a
run to be missed; a wrong run can't come out.

Defined results: null and empty texts have no words and no runs; words are
what ASCII white space leaves, compared as they are.  Rows are independent, so
repeats, ties and null ids change nothing.  An empty table gives an empty result.  Only
``id_col`` and ``text_col`` are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, utf8

EXPONENT = 4
MIN_WORDS = 6
BATCH_BYTES = 4 << 20


def mix(x: np.ndarray, y: np.ndarray | int = 0) -> np.ndarray:
    """A 64-bit hash of one or two arrays of 64-bit numbers."""
    with np.errstate(over="ignore"):
        h = x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
        h ^= h >> np.uint64(29)
        h = (h + y) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
    return h


def window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours (one value per full window)."""
    out, reach = x, 1
    while reach < width:
        step = min(reach, width - reach)
        out = np.minimum(out[:-step], out[step:])
        reach += step
    return out


def synchronising_set(blocks: np.ndarray, t: int, left_out: np.ndarray) -> np.ndarray:
    """Positions chosen at scale ``t``; ``blocks[i]`` is the hash of t words from i, ``left_out`` marks blocks to omit."""
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    ids = np.where(left_out, none, blocks)
    least = window_min(ids, t + 1)
    return np.flatnonzero((least != none) & ((least == ids[:len(least)]) | (least == ids[t:])))


def proposals(contexts: np.ndarray, members: np.ndarray, t: int) -> list[tuple[int, int, int]]:
    """(begin, end, period): words x and x + period agree for begin <= x < end, by neighbouring members of equal context."""
    keys = contexts[members]
    order = np.argsort(keys, kind="stable")
    at, keys = members[order], keys[order]
    gap = at[1:] - at[:-1]
    good = np.flatnonzero((keys[1:] == keys[:-1]) & (gap >= t) & (gap < 2 * t))
    if not len(good):
        return []
    begin, period = at[good], gap[good]
    order = np.lexsort((begin, period))
    begin, period = begin[order], period[order]
    cuts = np.flatnonzero((period[1:] != period[:-1]) | (begin[1:] > begin[:-1] + 2 * t)) + 1
    first, last = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(begin)]]) - 1
    return list(zip(begin[first].tolist(), (begin[last] + 2 * t).tolist(), period[first].tolist()))


def extend(codes: np.ndarray, begin: int, end: int, period: int) -> tuple[int, int] | None:
    """The widest [begin, end) on which words x and x + period agree; None if the proposal itself does not hold."""
    if not np.array_equal(codes[begin:end], codes[begin + period:end + period]):
        return None
    step = 64
    while True:
        low = max(0, begin - step)
        differ = np.flatnonzero(codes[low:begin] != codes[low + period:begin + period])
        if len(differ):
            begin = low + int(differ[-1]) + 1
            break
        begin = low
        if low == 0:
            break
        step *= 2
    step, stop = 64, len(codes) - period
    while True:
        high = min(stop, end + step)
        differ = np.flatnonzero(codes[end:high] != codes[end + period:high + period])
        if len(differ):
            return begin, end + int(differ[0])
        end = high
        if high == stop:
            return begin, end
        step *= 2


def find_runs(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs of at least ``EXPONENT`` periods, by start, then period.

    ``codes`` holds documents of ``lengths`` words, the longest first, each followed by a mark of its own.
    """
    ends = np.cumsum(lengths + 1)
    found = np.empty((0, 3), np.int64)
    t, blocks = 1, mix(codes.astype(np.uint64))
    while True:
        long_enough = int(np.count_nonzero(lengths >= EXPONENT * t))
        if not long_enough:
            return found[np.lexsort((found[:, 2], found[:, 0]))]
        codes = codes[:ends[long_enough - 1]]  # the documents that scale t can say something about
        blocks = blocks[:len(codes) - t + 1]
        known = found[(EXPONENT * found[:, 2] <= t) & (found[:, 1] >= t) & (found[:, 0] < len(codes))]
        edge = np.zeros(len(blocks) + 1, np.int64)
        np.add.at(edge, known[:, 0], 1)
        np.add.at(edge, known[:, 0] + known[:, 1] - t + 1, -1)
        contexts = mix(blocks[:-t], blocks[t:])
        members = synchronising_set(blocks, t, np.cumsum(edge[:-1]) > 0)
        here = set()
        for begin, end, period in proposals(contexts, members[members < len(contexts)], t):
            if stretch := extend(codes, begin, end, period):
                here.add((stretch[0], stretch[1] - stretch[0] + period, period))
        here = [run for run in here if run[1] >= EXPONENT * run[2]]
        found = np.concatenate([found, np.array(here, np.int64).reshape(-1, 3)])
        blocks, t = contexts, 2 * t


def runs_of(texts: list[list[bytes]], min_words: int = MIN_WORDS) -> list[np.ndarray]:
    """Per document, given as words, its runs (start, length, period) by start, then period."""
    lengths = np.array([len(w) for w in texts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    found = pa.array([w for k in order for w in texts[k]], pa.large_binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths[order])
    codes = np.insert(found, ends, len(found) + np.arange(len(order)))  # a mark after each document
    runs = find_runs(codes, lengths[order])
    runs = runs[runs[:, 1] >= min_words]
    starts = ends - lengths[order] + np.arange(len(order))
    at = np.searchsorted(starts, runs[:, 0], side="right") - 1
    # documents without words begin where the next one does; the last of equal starts holds the run, and it has words
    out: list[np.ndarray] = [np.empty((0, 3), np.int64)] * len(order)
    held, first = np.unique(at, return_index=True)  # runs come by start, so a document's lie together
    for k, mine in zip(held.tolist(), np.split(runs, first[1:])):
        out[order[k]] = mine - np.array([starts[k], 0, 0])
    return out


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Words that no run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.flatnonzero(np.cumsum(edge[:-1]) == 0)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _scan(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=BATCH_BYTES, rows=1 << 14):
            texts = [utf8(t).split() for t in batch.column(1).to_pylist()]
            found = runs_of(texts, min_words)
            flat = np.concatenate([*found, np.empty((0, 3), np.int64)])
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
            runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(_RUN)))
            collapsed = [b" ".join([w[k] for k in kept_words(len(w), r)] if len(r) else w).decode("utf-8", "surrogatepass") for w, r in zip(texts, found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(w) for w in texts], pa.int64()), runs, pa.array(collapsed, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """A row per document: doc_id, n_words, runs (array of start, length, period), collapsed (text without repeats)."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _scan(min_words), f"doc_id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run of greatest length / period, exactly; the smallest start, then period, among equals; null of none."""
    ahead = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    # runs come by start, then period, so the first of equals is kept
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, run: F.when(ahead(run, best), run).otherwise(best))


def run_report(docs: DataFrame, **options) -> DataFrame:
    """The digest columns of :func:`periodic_runs`."""
    found = periodic_runs(docs, **options).withColumn("best", strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the repeats that the query's contract writes into every tenth document.

    With h = crc32 of the id as text and g = h div 10, a text of n > 0 words and h mod 10 = 0 has its words
    i >= a = g mod n replaced by word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.col("text"), F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.expr("crc32(cast(doc_id AS string)) div 10").alias("g"))
    place = "IF(i < a, i, a + (i - a) % (1 + (size(w) - a) div (3 + g % 8)))"
    planted = F.expr(f"array_join(transform(transform(w, (x, i) -> {place}), k -> get(w, int(k))), ' ')")
    return (chosen.withColumn("a", F.when(F.size("w") > 0, F.col("g") % F.size("w")))
            .select("doc_id", F.when(F.size("w") > 0, planted).otherwise(F.col("text")).alias("text")))
