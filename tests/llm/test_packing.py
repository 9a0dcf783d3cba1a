import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from webfold.llm import packing
from webfold.llm.packing import cuts, encoder, pack, pack_histogram, price, token_ids

from .tables import documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
CASES = ([(k, "some words of text " * (k % 23)) for k in range(200)]
         + [(300, None), (301, ""), (302, "x" * 3000), (303, "a b c <|endoftext|> d"), (303, "a b c <|endoftext|> d"), (None, "no id"), (304, "ünï 日本 🙂\n\n  ")])


def reference_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def test_pieces_and_places(spark):
    got = pack(documents(spark, CASES, clashing=True), PATH).collect()
    want = defaultdict(list)
    for i, text in CASES:
        ids = np.array(reference_ids(text), "<u4")
        for k, (s, n) in enumerate(cuts(len(ids))):
            want[i].append((k, s, n, zlib.crc32(ids[s:s + n].tobytes())))
    have = defaultdict(list)
    for r in got:
        have[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    total = sum(r.length for r in got)
    assert len(sequences) <= -(-total // 1024) + 1


def test_empty_table(spark):
    assert pack(documents(spark, []), PATH).count() == 0


def test_cuts():
    assert cuts(1) == [(0, 1)] and cuts(1024) == [(0, 1024)] and cuts(1025) == [(0, 1), (1, 1024)]
    assert cuts(2500) == [(0, 452), (452, 1024), (1476, 1024)]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=200))
def test_ids_are_those_of_the_tokenizer_file(text):
    assert token_ids(encoder(PATH), text).tolist() == reference_ids(text)


def test_a_document_of_two_million_blanks(spark):
    """The faster library's pattern gives up on such a run."""
    for text in (" " * 2_000_000, "some words" + "\n \t" * 700_000 + "<|endoftext|>  more of them"):
        assert token_ids(encoder(PATH), text).tolist() == reference_ids(text)
    got = pack(documents(spark, [(1, "a b"), (2, "x" + " " * 2_000_000 + "y"), (3, "c")]), PATH)
    want = {1: len(reference_ids("a b")), 2: len(reference_ids("x" + " " * 2_000_000 + "y")), 3: len(reference_ids("c"))}
    assert {r.doc_id: r.n for r in got.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=20, max_size=20), st.integers(1, 50))
def test_any_histogram_is_packed_whole(counts, rounds):
    demand = np.array([0, *counts])
    plan = pack_histogram(demand, 20, rounds)
    assert (sum((c * n for c, n in plan), np.zeros(21, np.int64)) == demand).all()
    assert all(n > 0 and (c * np.arange(21)).sum() <= 20 for c, n in plan)


def test_close_to_the_bound_where_best_fit_alone_is_not():
    demand = np.zeros(1025, np.int64)
    demand[[342, 341, 171, 170]] = 6000  # three of a third, or pairs with halves of thirds
    plan = pack_histogram(demand, 1024)
    bound = -(-int((demand * np.arange(1025)).sum()) // 1024)
    assert sum(n for _, n in plan) <= 1.02 * bound


def test_pricing_is_an_exact_knapsack():
    rng = np.random.default_rng(3)
    for _ in range(20):
        value = np.concatenate([[0], rng.random(12) * (rng.random(12) < 0.6)])
        config = price(value, 12)
        best = np.zeros(13)
        for c in range(1, 13):
            best[c] = max([best[c - 1]] + [best[c - k] + value[k] for k in range(1, c + 1)])
        assert (config * np.arange(13)).sum() <= 12 and np.isclose((config * value).sum(), best[12])


def test_solver_has_no_state():
    demand = np.bincount(np.random.default_rng(1).integers(1, 100, 5000), minlength=101)
    a, b = packing.pack_histogram(demand, 100), packing.pack_histogram(demand, 100)
    assert [(c.tolist(), n) for c, n in a] == [(c.tolist(), n) for c, n in b]
