"""Phrases against plain substring search, held-out accuracy, and the odd cases."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from webfold.llm import language_id as L
from webfold.llm.common import table

from .tables import documents, rows

SF = "/root/testdata/sf0.1"


def plain_phrases(text, known):
    """Greedy longest substrings of ``known``; a symbol that it lacks is a phrase."""
    n = at = 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at:end + 1] in known:
            end += 1
        n, at = n + 1, end
    return n


def test_phrases_as_by_substring_search():
    rnd = random.Random(4)
    for _ in range(40):
        letters = rnd.randint(1, 6)
        known = bytes(rnd.randint(0, letters) for _ in range(rnd.randint(1, 200)))
        texts = sorted((bytes(rnd.randint(0, letters + rnd.randint(0, 2)) for _ in range(rnd.randint(1, 80))) for _ in range(12)), key=len, reverse=True)
        pieces = np.zeros((80, 12), np.int32)
        for k, text in enumerate(texts):
            pieces[:len(text), k] = list(text)
        made = L.suffix_automaton(list(known))
        assert made.states <= 2 * len(known) + 1 and len(made.keys) <= 3 * len(known) + 1
        got = L.phrases(made.table(), pieces, np.array([len(t) for t in texts]))
        assert got.tolist() == [plain_phrases(t, known) for t in texts]


def test_symbols():
    table = L.symbol_table(L.letters_of(["Ab b", None, "ß 12"]))
    assert L.as_symbols("  B--a, 7 ß!", table).tolist() == [table[ord("b")], 0, table[ord("a")], 0, table[ord("ß")]]
    assert table[ord("b")] == 1 and table[ord("語")] > L.OWN and table[ord("7")] == 0
    assert len(L.as_symbols(None, table)) == len(L.as_symbols(" 12 ", table)) == 0


def test_held_out_rows_of_the_given_table(spark):
    docs = table(spark, SF, "documents")
    got = L.languages(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    r = got.where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert r.right > 0.995 and 0 <= r.low <= r.high <= 1


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(8)
    words = {"aa": "kat pok tuk rak".split(), "bb": "mélo néva lué ona".split(), "語": "日本 中国 大学 学生".split()}
    data = [(100 + i, " ".join(rnd.choice(words[lang]) for _ in range(20)), lang) for i in range(90) for lang in [sorted(words)[i % 3]]]
    return words, data


def learn_from(spark, data, extra=()):
    df = documents(spark, [(i, t) for i, t, _ in data] + list(extra))
    langs = spark.createDataFrame([(i, lang) for i, _, lang in data], "doc_id bigint, l string")
    return df.join(langs, "doc_id", "left").withColumn("lang", F.col("l")).drop("l")


def test_any_script_and_odd_rows(spark, labelled):
    words, data = labelled
    odd = [(1, None), (2, ""), (3, "12 !?"), (4, "kat tuk"), (4, "kat tuk"), (None, "ona lué"), (5, "大学" * 40_000), (6, "ж")]
    got = {(r.doc_id, r.held_out): (r.lang_pred, r.score) for r in L.languages(learn_from(spark, data, odd).selectExpr("*", "1 AS score", "2 AS n", "3 AS stretch")).collect()}
    assert len(got) == 90 + 7
    by_id = {k[0]: v for k, v in got.items()}
    assert [by_id[k] for k in (1, 2, 3)] == [("und", 0.0)] * 3
    assert by_id[4][0] == "aa" and by_id[None][0] == "bb" and by_id[5][0] == "語" and (None, True) in got
    assert by_id[6][0] in words and all(0 <= s <= 1 for _, s in got.values())
    assert all(by_id[i][0] == lang for i, _, lang in data)


def test_labels_and_ids_are_no_input_of_a_prediction(spark, labelled):
    _, data = labelled
    docs = learn_from(spark, data)
    model = L.train(docs)
    one = rows(L.identify(docs, model), "lang_pred", "score")
    moved = docs.withColumn("doc_id", F.col("doc_id") * 7 + 1).withColumn("lang", F.lit("aa"))
    assert rows(L.identify(moved, model), "lang_pred", "score") == one


def test_sampling_is_by_text_and_bounded(spark, labelled):
    _, data = labelled
    model = L.train(learn_from(spark, data), stretches=2)
    assert [a.size <= 2 * (L.STRETCH + 1) for a in model.automata] == [True] * 3


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "abc"), (2, None)]).withColumn("lang", F.lit(None).cast("string"))
    assert rows(L.languages(docs), "doc_id", "lang_pred", "score") == [(1, "und", 0.0), (2, "und", 0.0)]
    assert L.languages(docs.limit(0)).count() == 0
