"""Codes against plain loops over all entries, and the odd cases."""
import hashlib
import math
import random

import numpy as np
from pyspark.sql import types as T

from webfold.llm import vector_codes as V

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def brute(rows, parts=4, entries=256, rounds=4):
    rows = sorted((i, [math.floor(1024 * float(np.float32(x))) for x in v], y) for i, v, y in rows)
    w = len(rows[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in rows]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for c in cut:
                held.setdefault(nearest(p, c[p])[1], []).append(c[p])
            for k, mine in held.items():
                books[p][k] = [sum(x) // len(mine) for x in zip(*mine)]
    out = {}
    for (i, _, y), c in zip(rows, cut):
        best = [nearest(p, c[p]) for p in range(parts)]
        out[i] = ("".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), y)
    text = ",".join(str(x) for book in books for e in book for x in e)
    return out, hashlib.sha256(text.encode()).hexdigest()


def some(n, width, seed=1):
    rnd = random.Random(seed)
    return [(i * 3, [rnd.gauss(0, 0.2) for _ in range(width)], rnd.choice([None, 1, 1, 2])) for i in range(n)]


def test_same_codes_as_brute_force(spark):
    for n, width in ((330, 8), (40, 16)):
        given = some(n, width)
        given[7] = (given[7][0], given[3][1], 1)  # equal vectors: ties between entries
        want, digest = brute(given)
        totals = {}
        for _, error, y in want.values():
            totals[y] = totals.get(y, 0) + error
        got = V.vector_codes(spark.createDataFrame(given, VECTORS).repartition(5)).collect()
        assert {r.vec_id: (r.code, r.error, r.label_error) for r in got} == {i: (c, e, totals[y]) for i, (c, e, y) in want.items()}
        assert {r.codebooks_sha256 for r in got} == {digest}


def test_distances_by_tables_are_those_of_the_numbers():
    rng = np.random.default_rng(2)
    for reach in (50, 1 << 24):
        rows, entries = rng.integers(-reach, reach, (2500, 6)), rng.integers(-reach, reach, (9, 6))
        assert np.array_equal(V.part_distances(*V.encode(rows), entries), ((rows[:, None] - entries) ** 2).sum(axis=2))


def test_labels_beyond_the_broadcast(spark):
    given = [(i, [i / 7.0, 0.0, 1.0, 2.0], i % 50 if i % 3 else None) for i in range(200)]
    coded, _ = V.compress(spark.createDataFrame(given, VECTORS), entries=4)
    want = sorted(V.with_label_error(coded).collect(), key=repr)
    assert sorted(V.with_label_error(coded, heavy=2).collect(), key=repr) == want  # only the nulls hold a third
    assert sorted(V.with_label_error(coded, heavy=1).collect(), key=repr) == want
    assert len(want) == 200


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    given = [(1, None, 1), (2, [0.5, None, 0.0, 0.0], 1), (3, [nan, 0.0, 0.0, 0.0], 1), (4, [inf, 0.0, 0.0, 0.0], 1), (5, [0.5, -0.5, 0.25, 0.0], None),
             (5, [0.5, -0.5, 0.25, 0.0], None), (None, [1e30, -1e30, 0.0, 0.0], 2), (6, [0.5, -0.5], 2), (7, [], 2)]
    vectors = spark.createDataFrame(given, VECTORS).selectExpr("*", "1 AS n", "2 AS code", "3 AS error", "4 AS v")
    got = V.vector_codes(vectors)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((r.vec_id or 0) for r in got.collect()) == [0, 5, 5, 6, 7]
    assert {r.error for r in got.collect()} == {0}  # as many entries as vectors
    empty = V.vector_codes(spark.createDataFrame([], VECTORS))
    assert empty.count() == 0 and empty.columns == got.columns
    assert V.vector_codes(spark.createDataFrame([(1, [], 1)], VECTORS)).first().code == "00000000"
