"""Toxicity and quality: held-out accuracy on the given tables, and the odd cases."""
import pytest
from pyspark.sql import functions as F

from webfold.llm import quality, toxicity
from webfold.llm.common import table

from .tables import documents

SF = "/root/testdata/sf0.1"
ODD = [(1, None), (2, ""), (3, "  "), (3, "  "), (None, "a b c"), (4, "w " * 30_000), (5, "loser idiot scum")]


@pytest.fixture(scope="module")
def given_tables(spark):
    return table(spark, SF, "documents"), table(spark, SF, "labels")


def test_toxicity_of_held_out_rows(given_tables):
    docs, labels = given_tables
    got = toxicity.toxicity(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    r = got.where("held_out").join(labels, "doc_id").agg(
        F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))).alias("recall"), F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("false")).first()
    assert r.recall > 0.65 and r["false"] < 0.005


def test_quality_of_held_out_rows(given_tables):
    docs, labels = given_tables
    r = (quality.quality(docs, labels).where("held_out").join(labels, "doc_id")
         .agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("right"),
              F.avg(F.when(F.col("quality") == 1, F.col("predicted"))).alias("kept")).first())
    assert r.right > 0.97 and r.kept > 0.98


def test_odd_rows_are_scored_and_clashing_columns_kept(spark):
    docs = documents(spark, ODD + [(10 + k, "nice words here" if k % 2 else "bad loser words") for k in range(60)], clashing=True)
    labels = spark.createDataFrame([(10 + k, k % 3 % 2, 1 - k % 2) for k in range(60)] + [(None, 1, 1), (11, None, None), (5000, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    for got in (toxicity.toxicity(docs, labels, min_docs=1), quality.quality(docs, labels)):
        scores = got.collect()
        assert len(scores) == len(ODD) + 60
        assert all(0 <= r.score <= 1 and r.held_out is not None and r.predicted in (0, 1) for r in scores)
    kept = toxicity.drop_toxic(docs, labels, min_docs=1)
    assert kept.columns == docs.columns
    assert 0 < kept.count() <= docs.count()
    toxic = {r.doc_id for r in toxicity.toxicity(docs, labels, min_docs=1).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == ({i for i, _ in ODD} | set(range(10, 70))) - toxic


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = documents(spark, ODD)
    assert {r.predicted for r in toxicity.toxicity(docs, none).collect()} == {0}
    assert {r.score for r in quality.quality(docs, none).collect()} == {0.5}
    assert toxicity.drop_toxic(docs, none).count() == len(ODD)
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0)], "doc_id bigint, quality int, toxic int")
    assert toxicity.toxicity(documents(spark, []), labels).count() == 0
    assert quality.quality(documents(spark, []), labels).count() == 0


def test_features_are_words_pairs_and_skip_pairs():
    assert len(toxicity.features("Some words, here: again")) == 4 + 3 + 2 + 1
    assert (toxicity.features("SOME words here") == toxicity.features("some,words here!")).all()
    assert len(toxicity.features(None)) == len(toxicity.features("?!")) == 0
    assert set(toxicity.features("x a y")) & set(toxicity.features("x b y")) >= set(toxicity.features("x a y")[-1:])


def test_labels_and_metadata_are_no_inputs_of_a_toxicity_score(spark, given_tables):
    docs, labels = given_tables
    model = toxicity.train(docs, labels, per_class=200, epochs=1)
    assert model.score("same text") == model.score("same text")
    assert len(model.buckets) == len(model.weights)


def test_all_unlabelled_rows_take_part_in_the_exchange(spark, monkeypatch):
    """Far more rows than were labelled; those of a rare source are given too, and a refit of them is that of all rows at once."""
    import numpy as np
    n, rare = 30_000, 12
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("Good words stand here in line "), F.col("id").cast("string"), F.lit(" and end well."))).otherwise(
            F.concat(F.lit("#### $$$ !!! 1234 "), F.col("id").cast("string"), F.lit(" ||| %%%"))).alias("text"),
        F.lit("en").alias("lang"), F.when(F.col("id") % (n // rare) == 1, "rare").when(F.col("id") % 2 == 0, "journal").otherwise("spam").alias("source"), F.lit(40).alias("n_chars"))
    labels = spark.range(400).select(F.col("id").alias("doc_id"), (1 - F.col("id") % 2).cast("int").alias("quality"))
    seen = []
    real = quality.refit

    def spy(models, labelled, given, counts, **kw):
        out = real(models, labelled, given, counts, **kw)
        seen.append((counts, given.where("source = 'rare' AND given1 = 0").count(), given, labelled, models, out))
        return out
    monkeypatch.setattr(quality, "refit", spy)
    got = quality.quality(docs, labels)
    assert got.where((F.col("predicted") != 1 - F.col("doc_id") % 2)).count() == 0
    counts, rare_given, given, labelled, before, after = seen[-1]
    assert min(counts) > 2_000 and rare_given > 0 and sum(c[0] for c, *_ in seen) > 8_000
    rows = given.where("given0 IS NOT NULL").collect()
    x = np.array([r.stats for r in rows], float)
    y = np.array([r.given0 for r in rows], float)
    m, (x0, y0) = before[0], labelled[0]
    w = np.append(m.weights, m.bias)
    weight = min(1.0, len(y0) / len(y))
    for _ in range(quality.NEWTON_STEPS):
        z, z0 = quality._design(m, x), quality._design(m, x0)
        p, p0 = (1 / (1 + np.exp(-np.clip(a @ w, -30, 30))) for a in (z, z0))
        h = (z0 * (p0 * (1 - p0) + 1e-9)[:, None]).T @ z0 + weight * (z * (p * (1 - p) + 1e-9)[:, None]).T @ z
        ridge = np.append(np.ones(len(w) - 1), 1e-6)
        step = np.linalg.solve(h + np.diag(ridge), z0.T @ (y0 - p0) + weight * z.T @ (y - p) - ridge * w)
        w = w + step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
    assert np.allclose(np.append(after[0].weights, after[0].bias), w, atol=1e-2)
