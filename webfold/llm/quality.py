"""Document quality by co-training a text view and a metadata view.

The text view sees statistics of the whole text (symbols, case, repetition,
word and line lengths); the metadata view sees language, source and length as
recorded.  Both are logistic regressions.  They start from a bounded sample of
labelled rows (``per_class`` each, in expectation, chosen by a hash of the id)
and take turns over ``ROUNDS`` rounds on all unlabelled rows: the rows of which
one view is most confident become training rows of the other, with its label.
Rounds run in Spark: both views score the written features, quantiles tell the
surest rows, and each Newton step of a new fit sums its terms over all rows that were
given, which together weigh at most as much as the labelled ones.  Only models
and such sums pass through the driver.  On labelled rows that neither view has trained on,
each view's log-odds are calibrated, and a last regression combines the two
calibrated views (a view that tells nothing gets no weight).  The models are a
few dozen numbers; every document is scored.

One scan of the texts makes the statistics of all documents; training reads
the sample from that narrow table.

Defined results: null and empty texts have zero statistics; null language,
source and n_chars are values of their own; labels of unknown documents, null
labels and null ids don't train; repeated rows are scored row by row; without
labelled rows of both classes every score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, slices
from .toxicity import held_out

ROUNDS = 4
SOURCES = 64
LANGUAGES = 16
TEXT_FEATURES = 16
META_FEATURES = LANGUAGES + SOURCES + 12


def text_features(text: str | None) -> list[float]:
    """Sixteen statistics of a text, each about 0 to 1."""
    if not text or not text.strip():
        return [0.0] * TEXT_FEATURES
    words = text.split()
    lines = text.split("\n")
    n, chars = len(words), len(text)
    distinct: dict[str, int] = {}
    for w in words:
        distinct[w] = distinct.get(w, 0) + 1
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    size = len(data)
    kinds = np.bincount(data, minlength=256)
    upper = int(kinds[65:91].sum())
    letters = upper + int(kinds[97:123].sum()) + int(kinds[128:].sum())
    stops = int(kinds[[46, 33, 63]].sum())
    return [
        1 - (letters + int(kinds[32]) + int(kinds[10])) / size,  # digits, punctuation, symbols
        int(kinds[[35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 92, 94, 95, 96, 123, 124, 125, 126]].sum()) / size,
        int(kinds[33]) / size * 10,
        int(kinds[124]) / size * 10,
        int(kinds[48:58].sum()) / size,
        upper / max(1, letters),
        len(distinct) / n,
        max(distinct.values()) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        min(1.0, chars / n / 20),
        min(1.0, max(map(len, words)) / 60),
        len(set(lines)) / len(lines),
        min(1.0, n / len(lines) / 100),
        min(1.0, stops / n * 5),
        min(1.0, np.log1p(n) / 10),
        sum(w[0].islower() for w in words) / n,
    ]


def meta_features(lang: list, source: list, n_chars: list) -> np.ndarray:
    """One-hot language and source (hashed) and size class, a row each."""
    out = np.zeros((len(lang), META_FEATURES))
    for k, (a, b, c) in enumerate(zip(lang, source, n_chars)):
        out[k, zlib.crc32(repr(a).encode()) % LANGUAGES] = 1
        out[k, LANGUAGES + zlib.crc32(repr(b).encode()) % SOURCES] = 1
        out[k, LANGUAGES + SOURCES + (11 if c is None else min(10, max(0, int(c)).bit_length() // 2))] = 1
    return out


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights + self.bias


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 30) -> Logistic:
    """Regularised logistic regression by Newton steps."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 0.02)  # a value that the sample lacks must not weigh without bound
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    ridge = np.full(z.shape[1], penalty)
    ridge[-1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * w)
        w += step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(mean, scale, w[:-1], float(w[-1]))


@dataclass
class Model:
    views: tuple[Logistic, Logistic] | None
    calibrated: tuple[Logistic, Logistic] | None
    combined: Logistic | None

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        if self.views is None:
            return np.full(len(text), 0.5)
        both = np.column_stack([c.logit(v.logit(x)[:, None]) for v, c, x in zip(self.views, self.calibrated, (text, meta))])
        return 1 / (1 + np.exp(-np.clip(self.combined.logit(both), -35, 35)))


SURE = float(np.log(9))  # log-odds of a confident row: 0.9, or 0.1 below zero
NEWTON_STEPS = 8


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Text and metadata features of the columns lang, source, n_chars, stats."""
    lang, source, n_chars, stats = (batch.column(c).to_pylist() for c in ("lang", "source", "n_chars", "stats"))
    return np.array(stats, float).reshape(batch.num_rows, TEXT_FEATURES), meta_features(lang, source, n_chars)


_STATE = "tie double, lang string, source string, n_chars bigint, stats array<float>, given0 int, given1 int"


def _surest(models):
    """Adds each view's log-odds, told apart among equals by a hash of the id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            tie = batch.column("tie").to_numpy() * 1e-6
            logits = [pa.array(m.logit(x) + tie) for m, x in zip(models.value, _views(batch))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *logits], names=[*batch.schema.names, "s0", "s1"])
    return run


def newton_terms(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Upper triangle of the Hessian and the gradient of the likelihood at ``w``, as one vector."""
    p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
    hessian = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z
    return np.concatenate([hessian[np.triu_indices(len(w))], z.T @ (y - p)])


def _design(model: Logistic, x: np.ndarray) -> np.ndarray:
    return np.column_stack([(x - model.mean) / model.scale, np.ones(len(x))])


def _newton(models):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0.0, 0.0]
        for batch in slices(batches):
            for k, x in enumerate(_views(batch)):
                y = batch.column(f"given{k}").to_numpy(zero_copy_only=False).astype(float)  # null is NaN
                m = models.value[k]
                mine = ~np.isnan(y)
                sums[k] = sums[k] + newton_terms(_design(m, x[mine]), y[mine], np.append(m.weights, m.bias))
        for k in (0, 1):
            if np.ndim(sums[k]):
                at = np.flatnonzero(sums[k])
                yield pa.RecordBatch.from_pydict({"view": pa.array(np.full(len(at), k), pa.int32()), "at": pa.array(at, pa.int32()), "total": pa.array(sums[k][at])})
    return run


def refit(models: list[Logistic], labelled: list[tuple[np.ndarray, np.ndarray]], given: DataFrame, counts: list[int], penalty: float = 1.0) -> list[Logistic]:
    """Newton steps on the labelled rows and all rows that were given to a view, which weigh together at most as much as the labelled."""
    spark = given.sparkSession
    for _ in range(NEWTON_STEPS):
        sent = spark.sparkContext.broadcast(models)
        sums = (given.where("given0 IS NOT NULL OR given1 IS NOT NULL").mapInArrow(_newton(sent), "view int, at int, total double")
                .groupBy("view", "at").agg(F.sum("total").alias("total")).collect())  # at most a triangle of features a view
        sent.unpersist()
        moved, new = 0.0, []
        for k, (m, (x, y)) in enumerate(zip(models, labelled)):
            w = np.append(m.weights, m.bias)
            terms = newton_terms(_design(m, x), y, w)
            extra = np.zeros_like(terms)
            for r in sums:
                if r.view == k:
                    extra[r.at] = r.total
            terms = terms + extra * min(1.0, len(y) / max(1, counts[k]))
            d = len(w)
            hessian = np.zeros((d, d))
            hessian[np.triu_indices(d)] = terms[:-d]
            hessian = hessian + np.triu(hessian, 1).T
            ridge = np.full(d, penalty)
            ridge[-1] = 1e-6
            step = np.linalg.solve(hessian + np.diag(ridge), terms[-d:] - ridge * w)
            w = w + step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
            moved = max(moved, float(np.abs(step).max()))
            new.append(Logistic(m.mean, m.scale, w[:-1], float(w[-1])))
        models = new
        if moved < 1e-4:
            break
    return models


def co_train(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, unlabelled: DataFrame, rounds: int = ROUNDS,
             share: float = 0.05) -> tuple[Logistic, Logistic]:
    """Each round, every view hands the other the rows it is surest of, ``share`` of all unlabelled rows in the classes' proportion.

    ``unlabelled`` (the columns of :data:`_STATE`, on a checkpoint) is scored whole each round; what is surest is told by
    approximate quantiles of the rows that are still free, and a row is given to a view once.
    """
    spark = unlabelled.sparkSession
    labelled = [(v, y) for v in views]
    models = [fit(v, y) for v in views]
    n, counts = unlabelled.count(), [0, 0]
    state, take = unlabelled, share * n
    for _ in range(rounds if n else 0):
        sent = spark.sparkContext.broadcast(models)
        scored = cut(state.mapInArrow(_surest(sent), _STATE + ", s0 double, s1 double"))
        sent.unpersist()
        bounds = []
        for k in (0, 1):  # view k gives to the other
            free = max(1, n - counts[1 - k])
            ranks = [min(1.0, take * (1 - y.mean()) / free), max(0.0, 1 - take * y.mean() / free)]
            bounds.append(F.percentile_approx(F.when(F.col(f"given{1 - k}").isNull(), F.col(f"s{k}")), ranks, 10_000).alias(f"b{k}"))
        b = scored.agg(*bounds).first()
        given = {}
        for k in (0, 1):
            old, s = F.col(f"given{1 - k}"), F.col(f"s{k}")
            low, high = b[f"b{k}"] or (None, None)
            if low is None:
                given[f"given{1 - k}"] = old
                continue
            given[f"given{1 - k}"] = F.when(old.isNotNull(), old).when((s >= high) & (s > SURE), 1).when((s <= low) & (s < -SURE), 0)
        state = scored.withColumns(given).drop("s0", "s1")
        c = state.agg(F.count("given0").alias("c0"), F.count("given1").alias("c1")).first()
        counts = [c.c0, c.c1]
        models = refit(models, labelled, state, counts)
    return models[0], models[1]


def train(features: DataFrame, labels: DataFrame, label_col: str = "quality", per_class: int = 4000) -> Model:
    """``features`` is the table of :func:`text_statistics`; a quarter of the labelled sample calibrates."""
    usable = (labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1) & ~held_out())
              .groupBy("doc_id").agg(F.max(label_col).alias("label")))
    sizes = {r.label: r.n for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model(None, None, None)
    draw = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30)) / (1 << 30)
    chosen = usable.where(draw < F.when(F.col("label") == 1, min(1.0, per_class / sizes[1])).otherwise(min(1.0, per_class / sizes[0])))
    rows = features.join(F.broadcast(chosen), "doc_id").orderBy("doc_id").collect()
    unlabelled = cut(features.where(F.col("doc_id").isNotNull() & ~held_out()).join(usable.select("doc_id"), "doc_id", "left_anti").select(
        draw.alias("tie"), "lang", "source", "n_chars", "stats", F.lit(None).cast("int").alias("given0"), F.lit(None).cast("int").alias("given1")))

    def matrix(rs):
        text = np.array([r.stats for r in rs], float).reshape(len(rs), TEXT_FEATURES)
        return text, meta_features([r.lang for r in rs], [r.source for r in rs], [r.n_chars for r in rs])
    y = np.array([r.label for r in rows], float)
    views = matrix(rows)
    aside = np.array([zlib.crc32(f"{r.doc_id} aside".encode()) % 4 == 0 for r in rows], bool)
    if len(set(y[aside])) < 2 or len(set(y[~aside])) < 2:
        aside[:] = False
    learn, check = (~aside, aside) if aside.any() else (np.ones(len(y), bool),) * 2
    if len(set(y)) < 2:
        return Model(None, None, None)
    models = co_train((views[0][learn], views[1][learn]), y[learn], unlabelled)
    logits = [m.logit(v[check])[:, None] for m, v in zip(models, views)]
    calibrated = tuple(fit(x, y[check]) for x in logits)
    combined = fit(np.column_stack([c.logit(x) for c, x in zip(calibrated, logits)]), y[check])
    # the sample's class balance is not the table's
    share = min(1.0, per_class / sizes[1]) / min(1.0, per_class / sizes[0])
    combined.bias -= float(np.log(share))
    return Model(models, calibrated, combined)


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_chars and the text's statistics."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            stats = pa.array([text_features(t) for t in batch.column(4).to_pylist()], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], stats], names=["doc_id", "lang", "source", "n_chars", "stats"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("bigint"), "text")
            .mapInArrow(run, f"doc_id {kind}, lang string, source string, n_chars bigint, stats array<float>"))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **training) -> DataFrame:
    """A row per document: doc_id, held_out, score (0 to 1, higher is better), predicted (1 if score >= threshold)."""
    features = cut(text_statistics(docs))
    model = docs.sparkSession.sparkContext.broadcast(train(features, labels, **training))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, held, lang, source, n_chars, stats = batch.columns
            text = np.array(stats.to_pylist(), float).reshape(batch.num_rows, TEXT_FEATURES)
            scores = model.value.score(text, meta_features(lang.to_pylist(), source.to_pylist(), n_chars.to_pylist()))
            yield pa.RecordBatch.from_arrays([ids, held, pa.array(scores, pa.float64())], names=["doc_id", "held_out", "score"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (features.select("doc_id", held_out().alias("held_out"), "lang", "source", "n_chars", "stats")
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
            .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))
