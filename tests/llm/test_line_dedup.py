import random
import re

from pyspark.sql import functions as F

from webfold.llm.line_dedup import dedup_lines

from .tables import documents


def near(a, b):
    """At most one word inserted, deleted or replaced, by the table of edit distances."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1] <= 1


def brute(cases, digests):
    order, seen, out = {}, [], {}
    docs = sorted(set(cases), key=lambda c: (c[0] is not None, c[0] or 0, digests[c[1]]))
    for doc in docs:
        kept, n, stay = [], 0, 0
        for line in (doc[1] or "").split("\n") if doc[1] is not None else []:
            w = tuple(re.findall(r"[^ \t\n\x0b\x0c\r]+", line))
            if not w:
                kept.append(line)
                continue
            n += 1
            gone = w in order or len(w) >= 4 and any(len(s) >= 4 and abs(len(s) - len(w)) <= 1 and near(s, w) for s in seen)
            if w not in order:
                order[w] = True
                seen.append(w)
            if not gone:
                kept.append(line)
                stay += 1
        out[doc] = (n, stay, "\n".join(kept) if doc[1] is not None else None)
    return sorted(((i, *out[(i, t)]) for i, t in cases), key=repr)


def corpus(seed):
    r = random.Random(seed)
    words = "alpha beta gamma delta eps zeta eta theta iota kappa".split()
    lines = [[r.choice(words) for _ in range(r.choice((1, 2, 3, 4, 4, 5, 6, 9, 20)))] for _ in range(40)]
    lines += [["hot", "line", "that", "is", "everywhere"]] * 10
    cases = []
    for i in range(60):
        doc = []
        for _ in range(r.randint(0, 6)):
            line = list(r.choice(lines))
            for _ in range(r.choice((0, 0, 1, 1, 2))):
                at = r.randrange(len(line) + 1)
                edit = r.choice("idr")
                if edit == "i":
                    line.insert(at, r.choice(words))
                elif line and at < len(line):
                    line[at:at + 1] = [r.choice(words)] if edit == "r" else []
            doc.append(r.choice((" ", "  ", "\t")).join(line))
            if r.random() < 0.1:
                doc.append(" ")
        cases.append((i, "\n".join(doc)))
    big = " ".join(f"w{k}" for k in range(1200))
    return cases + [(100, None), (101, ""), (102, big), (103, big.replace("w700", "v")), (104, big + " more"), (None, "a b c d e"), (105, "a b c d f"),
                    (3, cases[3][1]), (3, "another text of id three")]


def test_against_brute_force(spark):
    for seed in (1, 2):
        cases = corpus(seed)
        docs = documents(spark, cases, clashing=True)
        digests = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
        got = dedup_lines(docs)
        assert sorted((tuple(r) for r in got.select("doc_id", "n_lines", "n_kept", "text").collect()), key=repr) == brute(cases, digests)


def test_empty_table(spark):
    assert dedup_lines(documents(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = dedup_lines(documents(spark, [(1, "a b c d\na b c e")]).withColumn("x", F.lit(1)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_a_document_of_many_lines(spark):
    from pyspark.sql import functions as F

    from webfold.llm.line_dedup import dedup_lines
    line = F.transform(F.sequence(F.lit(0), F.lit(199_999)), lambda k: F.when(k % 2 == 0, F.lit("the same line again")).otherwise(F.concat(F.lit("own"), k.cast("string"))))
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.array_join(line, "\n").alias("text"))
    r = dedup_lines(docs).select("n_lines", "n_kept", F.length("text").alias("n"), F.substring("text", 1, 30).alias("head")).first()
    assert (r.n_lines, r.n_kept, r.head) == (200_000, 100_001, "the same line again\nown1\nown3\n")
