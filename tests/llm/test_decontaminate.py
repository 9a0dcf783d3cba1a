import hashlib
import re

from webfold.llm.decontaminate import drop_leaks, find_leaks, leak_report

from .tables import documents, rows

ITEMS = [("q1", "One two, three four five six seven eight nine ten ELEVEN twelve!"), ("q2", "short Question here"), ("q3", "..."), ("q4", None),
         ("q2", "another wording of it"), (None, "never asked before"), ("q5", "Größe über alles ist a1 b2 c3 d4 e5 f6 g7"), ("q10", "short question here")]
CASES = [
    (1, "Intro. one two three FOUR five six seven eight nine ten eleven end"), (2, "two three four five six seven eight nine ten eleven twelve thirteen"),
    (3, "one two three four five six seven eight nine"), (4, "A short  question,here. And short question here"), (5, "never asked before"),
    (6, None), (7, ""), (8, " ,.; "), (9, "größe ÜBER alles ist a1 b2 c3 d4 e5 f6 g7"), (10, "Größe über alles ist a1 b2 c3 d4 e5 f6 g7"),
    (11, "word " * 30_000 + "short question here " + "tail " * 10), (11, "short question here"), (None, "another wording of it"), (12, "shortquestion here"),
]


def wordlist(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(cases, items):
    out = []
    for i, text in cases:
        w, hit, ids = wordlist(text), set(), set()
        for item, q in items:
            q = wordlist(q)
            for s in range(max(1, len(q) - 9) if q else 0):  # of an item without id too: its words are hit, there is no id to list
                win = q[s:s + 10]
                for k in range(len(w) - len(win) + 1):
                    if w[k:k + len(win)] == win:
                        hit |= set(range(k, k + len(win)))
                        ids |= {item} - {None}
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def items(spark, data=ITEMS):
    return spark.createDataFrame(data, "item_id string, text string")


def test_against_brute_force(spark):
    got = leak_report(documents(spark, CASES, clashing=True), items(spark))
    assert rows(got, *got.columns) == brute(CASES, ITEMS)


def test_several_automata_find_the_same(spark):
    docs = documents(spark, CASES)
    one, many = (find_leaks(docs, items(spark), block=b) for b in (1000, 3))
    assert rows(one, *one.columns) == rows(many, *one.columns)


def test_spans_point_into_the_original_text(spark):
    for r in find_leaks(documents(spark, CASES), items(spark)).where("size(items) > 0").collect():
        text = dict((t, t) for _, t in CASES if t)
        parts = [w for a, b in r.spans for w in wordlist(next(t for t in text if len(wordlist(t)) == r.n_words and any(
            wordlist(t)[k] for k in r.hit) and [i for i, u in CASES if u == t and i == r.doc_id])[a:b])]
        assert len(parts) == len(r.hit)


def test_clean_rows_stay_whole(spark):
    docs = documents(spark, CASES, clashing=True)
    for block in (1000, 3):
        got = drop_leaks(docs, items(spark), block=block)
        assert got.columns == docs.columns
        assert rows(got, "doc_id", "text") == sorted(((i, t) for (i, t), b in zip(CASES, [brute([c], ITEMS)[0][5] for c in CASES]) if not b), key=repr)


def test_empty_tables(spark):
    assert leak_report(documents(spark, []), items(spark)).count() == 0
    got = leak_report(documents(spark, CASES), items(spark, [])).collect()
    assert len(got) == len(CASES) and not any(r.contaminated for r in got)


def test_words_of_an_item_without_id_are_hit(spark):
    from webfold.llm.decontaminate import drop_leaks, leak_report
    text = " ".join(f"q{k}" for k in range(12))
    items = spark.createDataFrame([(None, text), ("b", "other words"), (None, None)], "item_id string, text string")
    docs = documents(spark, [(1, "x " + text), (2, "clean"), (3, "other words"), (4, None)])
    for block in (60_000, 1):
        got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in leak_report(docs, items).collect()}
        assert got == {1: (12, 0, True), 2: (0, 0, False), 3: (2, 1, True), 4: (0, 0, False)}
        assert sorted(r.doc_id for r in drop_leaks(docs, items, block=block).collect()) == [2, 4]
