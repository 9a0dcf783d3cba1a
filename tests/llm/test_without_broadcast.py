"""The shuffle joins that large tables take: no side is small enough to be broadcast."""
import pytest

from webfold.llm import common

from . import test_language_id as op11, test_line_dedup as op5, test_set_join as op3


@pytest.fixture(autouse=True)
def nothing_is_small(monkeypatch, spark):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    before = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    if before is None:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_jaccard_classes(spark):
    op3.test_classes_against_brute_force(spark)


def test_the_smallest_id_stays(spark):
    op3.test_the_smallest_id_of_a_class_stays(spark)


def test_lines(spark):
    op5.test_against_brute_force(spark)


def test_languages(spark):
    docs = op11.documents(spark, [(k, ("kat pok tuk " if k % 2 else "mélo néva lué ") * 9) for k in range(40)]).withColumn("lang", op11.F.when(op11.F.col("doc_id") % 2 == 1, "aa").otherwise("bb"))
    got = op11.L.languages(docs).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("lang <> lang_pred").count() == 0 and got.count() == 40


def test_nothing_was_marked(spark):
    side = common.sized(common.cut(spark.range(3)))
    assert "broadcast" not in side._jdf.queryExecution().logical().toString().lower()
