"""Small helpers that several operators share."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webfold.functions.batches import give_back, slices  # noqa: F401  (the operators take them from here)
from webfold.session import ensure_checkpoint_dir

#: Rows (of a few numbers each) up to which a side is broadcast; beyond, a shuffle join is used.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows, written to the shared checkpoint folder, so lineage (and lost executors) end here."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def sized(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` (:data:`BROADCAST_ROWS`) rows of fixed-width columns.

    ``df`` must be cheap to count (a checkpoint).  A larger one is returned as
    it is and joins by a shuffle.
    """
    rows = BROADCAST_ROWS if rows is None else rows
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Byte table of the word rule [0-9a-z\x80-￿]: A-Z lower-cased, other ASCII to a space.
#: In UTF-8 every byte of a non-ASCII character is >= 0x80, so the rule on characters is a rule on bytes.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A or 0x30 <= b <= 0x39 else 0x20
    for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Lower-cased words of letters, digits and non-ASCII characters, as UTF-8 bytes; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def group_sum(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and the sums of their values."""
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, weights=values, minlength=len(found)).astype(np.int64)
