import random
import sys

import corpus_pipeline
from webfold.llm.packing import encoder, token_ids
from webfold.llm.queries import TOKENIZER
from webfold.llm.toxicity import toxicity

from .tables import CLASHING, documents
from .test_decontaminate import brute as leaks
from .test_set_join import brute as classes

BENCHMARK = [("q1", "which of these seven words comes last in the long list of words"), ("q2", "short item")]


def corpus():
    r = random.Random(4)
    word = lambda: "".join(r.choices("abcdefgh", k=4))
    rows = []
    for i in range(400):
        w = [word() for _ in range(r.randint(8, 60))]
        if i % 4 == 0:
            w[r.randrange(len(w))] = "horridword"
        rows.append((i, " ".join(w)))
    base = [word() for _ in range(120)]
    for i in range(400, 440):  # near copies
        w = list(base)
        w[r.randrange(120)] = word()
        rows.append((i, " ".join(w)))
    rows += [(k, rows[1][1]) for k in range(440, 470)]  # exact copies
    rows += [(k, rows[k - 469][1] + " " + BENCHMARK[0][1]) for k in range(470, 480)]
    rows += [(480, "a Short   item?"), (481, None), (482, ""), (483, None), (484, "x " * 5000), (None, "no id at all"), (485, "one")]
    return rows


def tables(spark, path, rows, clashing=False):
    documents(spark, rows, clashing).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int("horridword" in (t or ""))) for i, t in rows if i is not None and i < 400]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(BENCHMARK, "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def brute(rows, toxic):
    """Ids that reach the packing stage; ``toxic`` are the ids that the model rejects."""
    rows = [x for x in rows if x[0] not in toxic]
    best = {}
    for i, t in rows:
        best[t or ""] = max((x for x in (best.get(t or ""), i) if x is not None), default=None)
    rows = [(i, t) for i, t in rows if best[t or ""] == i]
    near = {(i, c) for i, _, c in classes(rows)}
    rows = [(i, t) for i, t in rows if (i, i) in near]
    return [(i, t) for i, t in rows if not leaks([(i, t)], BENCHMARK)[0][5]]


def test_stages_against_brute_force(spark, tmp_path):
    path = tables(spark, str(tmp_path), corpus(), clashing=True)
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    toxic = {r.doc_id for r in toxicity(docs, labels).where("predicted = 1").collect()}
    bad = {i for i, t in corpus() if "horridword" in (t or "")}
    assert toxic <= bad and len(toxic) > 0.9 * len(bad)
    want = brute(corpus(), toxic)
    got = {}
    for r in corpus_pipeline.run(spark, path).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == {i: len(token_ids(encoder(TOKENIZER), t)) for i, t in want}
    assert len(want) < 330


def test_all_but_the_last_stage_return_the_columns_of_documents(spark, tmp_path):
    rows = corpus()[:60] + corpus()[-20:]
    path = tables(spark, str(tmp_path), rows, clashing=True)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *CLASHING]


def test_empty_tables(spark, tmp_path):
    path = tables(spark, str(tmp_path), [])
    assert corpus_pipeline.run(spark, path).count() == 0


def test_the_entry_works_without_the_subpackage(monkeypatch):
    import __spark_entry__ as entry
    assert "pipeline" in entry.queries() and "op3_jaccard_join" in entry.oracle_sql()
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert not [q for q in [*entry.queries(), *entry.oracle_sql()] if q.startswith("op") or q == "pipeline"]
    assert "article_manifest" in entry.queries()
