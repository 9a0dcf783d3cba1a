import hashlib
from collections import defaultdict

import numpy as np
from hypothesis import given, strategies as st

from webfold.llm.exact_dedup import drop_copies, exact_dedup, misra_gries

from .tables import documents, rows

CASES = ([(i, "hot") for i in range(0, 120, 2)] + [(i, f"text {i % 7}") for i in range(1, 60, 2)]
         + [(200, None), (201, ""), (202, " "), (203, "x" * 50_000), (204, "x" * 50_000), (None, "hot"), (None, "alone"), (118, "hot")])


def brute(cases):
    groups = defaultdict(list)
    for i, t in cases:
        groups[t or ""].append(i)
    return sorted(((i, max((x for x in groups[t or ""] if x is not None), default=None), len(groups[t or ""]),
                    hashlib.sha256((t or "").encode()).hexdigest()) for i, t in cases), key=repr)


def test_against_brute_force_with_heavy_and_light_texts(spark):
    for counters in (3, 1023):  # few counters: only "hot" is heavy; many: by the threshold
        got = exact_dedup(documents(spark, CASES, clashing=True), counters=counters)
        assert rows(got, "doc_id", "keep_id", "group_size", "text_sha256") == brute(CASES)
        kept = got.where("kept").collect()
        assert len(kept) == len({t or "" for _, t in CASES})
        assert all(r.doc_id == r.keep_id for r in kept)


def test_kept_rows_keep_all_columns(spark):
    docs = documents(spark, CASES, clashing=True)
    got = drop_copies(docs)
    assert got.columns == docs.columns
    want = {(max((i for i, u in CASES if (u or "") == (t or "") and i is not None), default=None), t or "") for _, t in CASES}
    assert sorted(((r.doc_id, r.text or "") for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert exact_dedup(documents(spark, [])).count() == 0
    assert drop_copies(documents(spark, [])).count() == 0


@given(st.lists(st.integers(0, 30), max_size=300), st.integers(1, 8))
def test_misra_gries_never_misses_a_frequent_item(items, counters):
    found, counts = np.empty(0, "S4"), np.empty(0, np.int64)
    for low in range(0, len(items), 40):
        part = np.array([str(x) for x in items[low:low + 40]], "S4")
        found, at = np.unique(np.concatenate([found, part]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([counts, np.ones(len(part), np.int64)]), len(found)).astype(np.int64)
        found, counts = misra_gries(found, counts, counters)
        assert len(found) <= counters
    have = dict(zip(found.tolist(), counts.tolist()))
    for x in set(items):
        real = items.count(x)
        assert real - len(items) / (counters + 1) <= have.get(str(x).encode(), 0) <= real
