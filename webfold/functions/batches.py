"""Arrow batches in a Python worker: a batch of Spark's may hold 10,000 rows, what is made of it at a time should not."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

M_MMAP_THRESHOLD = -3  # as in glibc's malloc.h


def slices(batches: Iterator[pa.RecordBatch], size: int = 4 << 20, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``size`` bytes, so that what a task makes of one stays small in memory."""
    for batch in batches:
        step = max(1, min(rows, size * batch.num_rows // max(1, batch.nbytes)))
        for low in range(0, batch.num_rows, step):
            yield batch.slice(low, step)
    give_back()


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on after its task, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)


def large_apart(size: int = 1 << 20) -> None:
    """From now on, memory of ``size`` bytes or more goes back to the system when it is freed.

    Else glibc puts what is as large as a batch on its heap once one was freed; the next batch has another size, and the gap stays.
    """
    if mallopt := getattr(ctypes.CDLL(None), "mallopt", None):  # glibc
        mallopt(M_MMAP_THRESHOLD, size)


def strings(f: Callable[..., str | None], batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """``f`` of each row's values, a slice at a time: for :func:`pyspark.sql.functions.arrow_udf` over iterators."""
    large_apart()
    for part in slices((pa.RecordBatch.from_arrays(list(b), [str(k) for k in range(len(b))]) for b in batches), 1 << 20, 256):
        yield pa.array([f(*row) for row in zip(*[c.to_pylist() for c in part.columns])], pa.string())
