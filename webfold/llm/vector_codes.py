"""Vector code compression by per-dimension value dictionaries.

Vectors become integers (floor of ``SCALE`` times a component), are cut into
``PARTS`` equal consecutive parts, and each part is coded by the nearest of up to
``ENTRIES`` codebook entries.  The vectors are written once, as blocks of up to
``BLOCK_ROWS`` rows: per dimension the sorted distinct integers (its value
dictionary) and a 16-bit code per row.  To assign a block, the squared
differences of every distinct integer to all entries are tabulated per
dimension; a part's distances are then gathers from those tables by dictionary
code, added up.  A dictionary is a block's own, so tables stay bounded however
many different values a dimension has in all.

A round assigns every part and sums the parts of each entry per task; the sums
meet in an aggregation with map-side combine of at most entries x width rows,
the only thing that reaches the driver.  Codebooks are broadcast (entries x
width integers).  Error sums per label are an aggregation; labels that hold a
thousandth of the rows or more (a thousand at most) are broadcast back, the
others joined by a shuffle.

Defined results: rows whose vector is null or holds null or non-finite
components are dropped.  Integers beyond +-2**24 are held there, so that
distances fit a long.  Vectors shorter than the longest, and a longest length
that is no multiple of ``parts``, are filled with zeros.  Codebooks start from the
smallest ids (null ids last, ties by the integers); with fewer vectors than
entries the codebooks are that much shorter.  Repeated rows are each a vector.
Null labels are a label together.  An empty table gives an empty result.  Only
the three named columns are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, give_back, slices

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK_ROWS = 8192
LIMIT = 1 << 24


def is_finite_vector(vector: Column) -> Column:
    """True for a vector without null, NaN or infinite components; false for a null vector."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))


def as_integers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))).cast("int"))


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """The integer vectors of a batch as rows, filled with zeros up to ``width``."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def encode(rows: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Per dimension the sorted distinct integers, and each row's 16-bit code there (dimension by row)."""
    found = [np.unique(column, return_inverse=True) for column in rows.T]
    codes = np.stack([code.astype(np.uint16) for _, code in found]) if found else np.zeros((0, len(rows)), np.uint16)
    return [values for values, _ in found], codes


def part_distances(dictionaries: list[np.ndarray], codes: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances (row by entry): a table per dimension, gathered by code and added."""
    tables = [np.square(values[:, None] - column) for values, column in zip(dictionaries, entries.T)]
    total = np.zeros((codes.shape[1], len(entries)), np.int64)
    if sum(int(t.max()) for t in tables) < 1 << 31:
        tables, total = [t.astype(np.int32) for t in tables], total.astype(np.int32)
    for low in range(0, len(total), 1024):  # a stretch that stays in the processor's cache
        rows = total[low:low + 1024]
        gathered = np.empty_like(rows)
        for table, code in zip(tables, codes):
            rows += np.take(table, code[low:low + 1024], axis=0, out=gathered, mode="clip")
    return total


def _blocks(width: int):
    names = ["vec_ids", "labels", "dictionaries", "codes"]

    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        ids, labels, vectors = (c.chunk(0) for c in table.columns)
        dictionaries, codes = encode(matrix(vectors, width))
        return pa.RecordBatch.from_arrays([
            pa.ListArray.from_arrays([0, len(ids)], ids), pa.ListArray.from_arrays([0, len(ids)], labels),
            pa.array([dictionaries], pa.list_(pa.list_(pa.int64()))), pa.array([codes.tobytes()], pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        rows = max(1, min(BLOCK_ROWS, (8 << 20) // max(1, width)))
        for batch in slices(batches, rows=rows):
            if n and n + batch.num_rows > rows:
                yield block(held)
                held, n = [], 0
            held.append(batch)
            n += batch.num_rows
        if n:
            yield block(held)
    return run


def _read(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array, list[np.ndarray], np.ndarray]]:
    for k in range(batch.num_rows):
        ids, labels = batch.column(0)[k].values, batch.column(1)[k].values
        dictionaries = [np.array(d, np.int64) for d in batch.column(2)[k].as_py()]
        codes = np.frombuffer(batch.column(3)[k].as_py(), np.uint16).reshape(len(dictionaries), len(ids))
        yield ids, labels, dictionaries, codes


def _sums(books):
    """Per task: (part, entry, at, total) with the count at -1; entries that got nothing give no row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.value.shape
        totals, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for _, _, dictionaries, codes in _read(batch):
                for p in range(parts):
                    mine = slice(p * width, (p + 1) * width)
                    nearest = part_distances(dictionaries[mine], codes[mine], books.value[p]).argmin(axis=1)
                    counts[p] += np.bincount(nearest, minlength=entries)
                    for j in range(width):
                        np.add.at(totals[p, :, j], nearest, dictionaries[p * width + j][codes[p * width + j]])
        whole = np.concatenate([counts[:, :, None], totals], axis=2)
        p, e = np.nonzero(counts)
        at = np.arange(-1, width)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(np.repeat(p, width + 1), pa.int32()), "entry": pa.array(np.repeat(e, width + 1), pa.int32()),
            "at": pa.array(np.tile(at, len(p)), pa.int32()), "total": pa.array(whole[p, e].ravel(), pa.int64())})
        give_back()
    return run


def _assign(books):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, _, width = books.value.shape
        for batch in batches:
            for ids, labels, dictionaries, codes in _read(batch):
                chosen, error = np.empty((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
                for p in range(parts):
                    mine = slice(p * width, (p + 1) * width)
                    distance = part_distances(dictionaries[mine], codes[mine], books.value[p])
                    chosen[:, p] = nearest = distance.argmin(axis=1)
                    error += distance[np.arange(len(ids)), nearest]
                text = chosen.tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array([text[k:k + 2 * parts] for k in range(0, len(text), 2 * parts)], pa.string()), pa.array(error)],
                    names=["vec_id", "label", "code", "error"])
        give_back()
    return run


def next_books(books: np.ndarray, sums: list) -> np.ndarray:
    """Each used entry becomes the floor of its parts' mean; others stay."""
    whole = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
    for part, entry, at, total in sums:
        whole[part, entry, at + 1] = total
    count = whole[:, :, :1]
    return np.where(count > 0, whole[:, :, 1:] // np.maximum(count, 1), books)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every kept vector, on a checkpoint; and the final codebooks (part, entry, position)."""
    if not 0 < entries <= 256:
        raise ValueError("a code is two hex digits: 1 to 256 entries")
    spark = vectors.sparkSession
    kept = (vectors.where(is_finite_vector(F.col(vector_col)))
            .select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), as_integers(F.col(vector_col), scale).alias("v")))
    kinds = [kept.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    width = -(-(kept.agg(F.max(F.size("v"))).first()[0] or 0) // parts)
    start = [r.v for r in kept.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()]
    books = np.zeros((parts, len(start), width), np.int64)
    for e, v in enumerate(start):
        books[:, e] = np.array(v + [0] * (parts * width - len(v)), np.int64).reshape(parts, width)
    blocks = cut(kept.mapInArrow(_blocks(parts * width), f"vec_ids array<{kinds[0]}>, labels array<{kinds[1]}>, dictionaries array<array<bigint>>, codes binary"))
    for _ in range(rounds if start else 0):
        sent = spark.sparkContext.broadcast(books)
        sums = (blocks.mapInArrow(_sums(sent), "part int, entry int, at int, total bigint")
                .groupBy("part", "entry", "at").agg(F.sum("total").alias("total")).collect())  # at most entries x (width + 1) a part
        books = next_books(books, sums)
        sent.unpersist()
    sent = spark.sparkContext.broadcast(books)
    coded = cut(blocks.mapInArrow(_assign(sent), f"vec_id {kinds[0]}, label {kinds[1]}, code string, error bigint"))
    return coded, books


def books_text(books: np.ndarray) -> str:
    """All integers in decimal, by part, entry and position, comma-joined."""
    return ",".join(map(str, books.ravel().tolist()))


HEAVY = 1000


def with_label_error(coded: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """``coded`` with ``label_error``: the error of all rows of the same label (nulls are one label)."""
    totals = cut(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"), F.count("*").alias("n")))
    rows = totals.agg(F.sum("n")).first()[0] or 0
    same = F.col("label").eqNullSafe(F.col("of"))
    few = F.broadcast(totals.where(F.col("n") * heavy >= rows).drop("n"))  # at most ``heavy`` labels hold so many rows
    rest = totals.where(F.col("n") * heavy < rows).drop("n")
    return (coded.join(few, same).drop("of")
            .unionByName(coded.join(few.select("of"), same, "left_anti").join(rest, same).drop("of")))


def vector_codes(vectors: DataFrame, **options) -> DataFrame:
    """A row per kept vector: vec_id, code, error, label_error, codebooks_sha256."""
    coded, books = compress(vectors, **options)
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
