"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of words, word pairs and pairs with one or two words
between, hashed to 2**BITS buckets; case and punctuation don't count.  Training
uses a sample of labelled rows bounded by ``per_class`` (in expectation, chosen
by a hash of the id), and buckets that at least ``min_docs`` sample rows hold
(more, if over ``max_features`` would be left).  The sample is dealt to ``SHARDS`` partitions;
in each epoch every shard runs FTRL-proximal (per-coordinate rates, L1
sparsity) from the common state, and the driver averages each coordinate over
the shards that changed it (arrays of at most ``max_features`` floats).  What
the L1 penalty leaves is a short list of weights, broadcast to score every
whole text in one narrow pass.  The scores are corrected for the class balance
of the sample.

Defined results: null and empty texts get the score of a text without words;
labels of unknown documents, null labels and null ids don't train; repeated
rows are scored row by row; without a labelled row of each class every score
is 0.  Only ``doc_id`` and ``text`` are read from the documents, and only
``text`` enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, slices, words
from .shingles import mix, runs

BITS = 24
SHARDS = 8
THRESHOLD = 0.7


def features(text: str | None) -> np.ndarray:
    """Buckets of all words, pairs and skip pairs of the text, with repeats."""
    h = runs(words(text), 1)
    u = np.uint64
    return np.concatenate([
        h,
        mix(h[:-1] * u(3) + h[1:]),
        mix(h[:-2] * u(5) + h[2:]) if len(h) > 2 else h[:0],
        mix(h[:-3] * u(7) + h[3:]) if len(h) > 3 else h[:0]]) >> u(64 - BITS)


@dataclass
class Model:
    buckets: np.ndarray  # sorted
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        if not len(self.buckets):
            return _sigmoid(self.bias)
        f = features(text)
        at = np.searchsorted(self.buckets, f)
        at = at[self.buckets[np.minimum(at, len(self.buckets) - 1)] == f]
        return _sigmoid(self.bias + float(self.weights[np.unique(at)].sum()))


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 4.0
    beta: float = 1.0
    l1: float = 2.0
    l2: float = 0.0

    def weights(self, z: np.ndarray, n: np.ndarray, l1: np.ndarray | float) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, z: np.ndarray, n: np.ndarray, at: np.ndarray, label: int) -> None:
        """One example; the last coordinate is the bias, free of the L1 penalty."""
        at = np.append(at, len(z) - 1)
        l1 = np.full(len(at), self.l1)
        l1[-1] = 0.0
        w = self.weights(z[at], n[at], l1)
        g = _sigmoid(float(w.sum())) - label
        sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / self.alpha
        z[at] += g - sigma * w
        n[at] += g * g


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [np.unique(features(t)).astype(np.int32) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.int32()))], names=["label", "shard", "at"])


_SLICE = 1 << 16  # buckets whose counts travel as one row


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, seen = np.zeros(1 << BITS, np.uint16), 0
    for batch in slices(batches):
        at, n = np.unique(batch.column(0).flatten().to_numpy(zero_copy_only=False), return_counts=True)
        seen += batch.num_rows
        if seen >= 1 << 16 and total.dtype == np.uint16:
            total = total.astype(np.uint32)
        total[at] += n.astype(total.dtype)
    for k in range(0, len(total), _SLICE):
        yield pa.RecordBatch.from_pydict({"slice": pa.array([k // _SLICE], pa.int32()), "counts": pa.array([total[k:k + _SLICE].astype(np.uint32).tobytes()], pa.binary())})


def _summed(min_docs: int):
    def run(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_py(), np.uint32).astype(np.int64) for c in table["counts"])
        at = np.flatnonzero(total >= min_docs)
        return pa.table({"at": pa.array(at + table["slice"][0].as_py() * _SLICE, pa.int32()), "n": pa.array(total[at], pa.int64())})
    return run


def common_buckets(sample: DataFrame, min_docs: int, max_features: int) -> np.ndarray:
    """Sorted buckets that at least ``min_docs`` rows hold; so many more if over ``max_features`` would be left."""
    counted = cut(sample.select("at").mapInArrow(_counts, "slice int, counts binary").groupBy("slice").applyInArrow(_summed(min_docs), "at int, n bigint"))
    least, kept = min_docs, 0
    for r in counted.groupBy("n").agg(F.count("*").alias("buckets")).orderBy(F.desc("n")).collect():  # at most a row per sample size
        kept += r.buckets
        if kept > max_features:
            least = r.n + 1
            break
    return np.sort(counted.where(F.col("n") >= least).select("at").toArrow()["at"].to_numpy())


def _epoch(state, ftrl: Ftrl, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, z, n = (x.copy() for x in state.value)
        rows = []
        for batch in slices(batches):
            for label, f in zip(batch.column(0).to_pylist(), batch.column(2)):
                f = f.values.to_numpy(zero_copy_only=False)
                at = np.searchsorted(buckets, f)
                rows.append((label, at[buckets[np.minimum(at, len(buckets) - 1)] == f] if len(buckets) else at[:0]))
        if rows:
            rows.sort(key=lambda r: (len(r[1]), r[1].tobytes(), r[0]))  # arrival order is not fixed
            for k in np.random.default_rng(seed).permutation(len(rows)):
                ftrl.learn(z, n, rows[k][1], rows[k][0])
            yield pa.RecordBatch.from_pydict({"z": pa.array([z.tobytes()], pa.binary()), "n": pa.array([n.tobytes()], pa.binary())})
    return run


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", per_class: int = 16_000, min_docs: int = 4,
          max_features: int = 1 << 17, epochs: int = 8, ftrl: Ftrl = Ftrl()) -> Model:
    """Learn from labelled rows that are not held out."""
    spark = docs.sparkSession
    usable = (labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1) & ~held_out())
              .groupBy("doc_id").agg(F.max(label_col).alias("label")))
    sizes = {r.label: r.n for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model(np.empty(0, np.uint64), np.empty(0), -35.0)
    rate = {k: min(1.0, per_class / n) for k, n in sizes.items()}
    share = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    chosen = usable.where(share < F.when(F.col("label") == 1, rate[1]).otherwise(rate[0]))
    sample = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
                 .select(F.col("label").cast("int").alias("label"), F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)).cast("int").alias("shard"), "text")
                 .mapInArrow(_sample_features, "label int, shard int, at array<int>"))
    dealt = cut(sample.repartition(SHARDS, "shard"))
    buckets = common_buckets(dealt, min_docs, max_features)
    z, n = np.zeros(len(buckets) + 1), np.zeros(len(buckets) + 1)
    for epoch in range(epochs):
        state = spark.sparkContext.broadcast((buckets, z, n))
        done = dealt.mapInArrow(_epoch(state, ftrl, epoch), "z binary, n binary").collect()
        zs, ns = (np.stack([np.frombuffer(r[k]) for r in done]) for k in ("z", "n"))
        active = np.maximum((ns > n).sum(axis=0), 1)
        z, n = z + (zs - z).sum(axis=0) / active, n + (ns - n).sum(axis=0) / active
        state.unpersist()
    l1 = np.full(len(z), ftrl.l1)
    l1[-1] = 0.0
    w = ftrl.weights(z, n, l1)
    keep = np.flatnonzero(w[:-1])
    return Model(buckets[keep].astype(np.uint64), w[keep], float(w[-1] + np.log(rate[0] / rate[1])))


def _scorer(model, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = pa.array([model.value.score(t) for t in batch.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *batch.columns[at + 1:], scores], names=[*batch.schema.names[:at], *batch.schema.names[at + 1:], "score"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **training) -> DataFrame:
    """A row per document: doc_id, held_out, score, predicted."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, **training))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", held_out().alias("held_out"), "text")
            .mapInArrow(_scorer(model, 2), f"doc_id {kind}, held_out boolean, score double")
            .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **training) -> DataFrame:
    """The rows of ``docs`` scored below ``threshold``, with all their columns, in one narrow pass."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, **training))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([model.value.score(t) < threshold for t in batch.column(at).to_pylist()], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
