"""Benchmark decontamination with one Aho-Corasick automaton.

Item texts and documents are normalised by the same byte rule (A-Z lower-cased;
words of digits, letters and non-ASCII characters).  Each item gives windows of
``width`` consecutive words, a shorter one its whole word run.  All distinct
windows, as bytes between spaces, form one automaton that is broadcast and
scans each document once; a match at a byte of the normalised text is mapped
to word numbers, and these to offsets in the original text.

The benchmark's windows are made by Spark.  One automaton holds at most
``block`` windows (about 4 kB of memory each at ten words); a larger benchmark
is dealt by window hash into as many automata as it needs, each scanning all
documents in turn and adding its hits to the row; between two automata the rows are written and the
first is released.  So what is held at a time is bounded whatever the benchmark's size.

Defined results: null and empty texts have no words; an item without words
is no question; the words of an item with a null id are hit like others', but there is no id to list; several rows of one item id are one item with
all their windows; a document row repeated in the table gives a row each;
empty tables give no rows, or rows without hits.  Only id and text columns are
read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, cut, slices, utf8, words

WIDTH = 10
BLOCK = 60_000


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(win, ids): each distinct window and the sorted ids of the items that hold it; items without an id add none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, wins = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = words(text)
                for i in range(max(1, len(w) - width + 1) if w else 0):
                    ids.append(item)
                    wins.append(b" ".join(w[i:i + width]))
            yield pa.RecordBatch.from_pydict({"item": pa.array(ids, pa.string()), "win": pa.array(wins, pa.binary())})
    return (items.select(F.col(id_col).cast("string"), text_col)
            .mapInArrow(run, "item string, win binary")
            .groupBy("win").agg(F.sort_array(F.collect_set("item")).alias("ids")))


def automaton(windows: list[bytes]) -> ahocorasick.Automaton:
    """Latin-1 strings stand for the bytes, a space on either side for the word boundaries."""
    a = ahocorasick.Automaton()
    for k, w in enumerate(windows):
        a.add_word(f" {w.decode('latin-1')} ", (k, w.count(b" ") + 1))
    if windows:
        a.make_automaton()
    return a


def scan(text: str | None, a: ahocorasick.Automaton) -> tuple[int, np.ndarray, set[int]]:
    """Number of words, sorted hit word numbers, and the windows found."""
    w = words(text)
    if not w or not len(a):
        return len(w), np.empty(0, np.int64), set()
    found = list(a.iter(f" {b' '.join(w).decode('latin-1')} "))
    if not found:
        return len(w), np.empty(0, np.int64), set()
    # the byte after word i in the joined text (which begins with one space)
    after = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    mark = np.zeros(len(w) + 1, np.int64)
    for end, (_, n) in found:
        last = int(np.searchsorted(after, end))
        mark[last - n + 1] += 1
        mark[last + 1] -= 1
    return len(w), np.flatnonzero(np.cumsum(mark[:-1]) > 0), {k for _, (k, _) in found}


def spans(text: str, hit: np.ndarray) -> list[list[int]]:
    """Character offsets [start, end) in the original text of each run of hit words."""
    if not len(hit):
        return []
    data = utf8(text)
    word = np.frombuffer(data.translate(WORD_BYTES), np.uint8) != 0x20
    edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
    gaps = np.flatnonzero(np.diff(hit) > 1)
    first, last = hit[np.concatenate([[0], gaps + 1])], hit[np.concatenate([gaps, [len(hit) - 1]])]
    return [[int(chars[begin[a]]), int(chars[end[b]])] for a, b in zip(first, last)]


def _scanner(windows, last: bool):
    """Adds one automaton's hits to what earlier ones found; the last drops the text and adds the spans."""
    state: dict = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not state:
            state["a"] = automaton([w for w, _ in windows.value])
        ids = windows.value
        for batch in slices(batches):
            counts, hits, items = [], [], []
            texts = batch.column(1).to_pylist()
            for text, hit0, items0 in zip(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                n, hit, keys = scan(text, state["a"])
                counts.append(n)
                hits.append(np.union1d(np.array(hit0, np.int32), hit.astype(np.int32)) if hit0 else hit.astype(np.int32))
                items.append(sorted({i for k in keys for i in ids[k][1]}.union(items0)))
            out = [batch.column(0), batch.column(1), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
            names = ["doc_id", "text", "hit", "items"]
            if last:
                out[1] = pa.array(counts, pa.int64())
                out.append(pa.array([spans(t, h) if len(h) else [] for t, h in zip(texts, hits)], pa.list_(pa.list_(pa.int32()))))
                names = ["doc_id", "n_words", "hit", "items", "spans"]
            yield pa.RecordBatch.from_arrays(out, names=names)
    return run


def _blocks(items: DataFrame, width: int, block: int) -> list[DataFrame]:
    windows = cut(item_windows(items, width=width))
    n = max(1, -(-windows.count() // block))
    return [windows.where(F.pmod(F.xxhash64("win"), F.lit(n)) == k).orderBy("win") for k in range(n)]


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """A row per document row: doc_id, n_words, hit (word numbers), items (ids), spans (character offsets)."""
    spark = docs.sparkSession
    found = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                        F.array().cast("array<int>").alias("hit"), F.array().cast("array<string>").alias("items"))
    parts = _blocks(items, width, block)
    id_type = found.schema["doc_id"].dataType.simpleString()
    for k, part in enumerate(parts, 1):
        sent = spark.sparkContext.broadcast([(bytes(r.win), list(r.ids)) for r in part.collect()])
        last = k == len(parts)
        found = found.mapInArrow(_scanner(sent, last), f"doc_id {id_type}, " + (
            "n_words bigint, hit array<int>, items array<string>, spans array<array<int>>" if last
            else "text string, hit array<int>, items array<string>"))
        if not last:
            found = cut(found)
            sent.unpersist()
    return found


def sha256_of_ids(ids: Column) -> Column:
    return F.sha2(F.array_join(ids, ","), 256)


def leak_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest columns of :func:`find_leaks`."""
    return find_leaks(docs, items).select(
        "doc_id", "n_words", F.size("hit").cast("bigint").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        sha256_of_ids(F.col("items")).alias("items_sha256"), (F.size("hit") > 0).alias("contaminated"))


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item, with all their columns: a narrow pass an automaton."""
    parts = _blocks(items, width, block)
    for k, part in enumerate(parts, 1):
        sent = docs.sparkSession.sparkContext.broadcast([bytes(r.win) for r in part.select("win").collect()])
        docs = docs.mapInArrow(_clean_only(sent, docs.columns.index(text_col)), docs.schema)
        if k < len(parts):
            docs = cut(docs)
            sent.unpersist()
    return docs


def _clean_only(windows, at: int):
    state: dict = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not state:
            state["a"] = automaton(windows.value)
        for batch in slices(batches):
            yield batch.filter(pa.array([not scan(t, state["a"])[2] for t in batch.column(at).to_pylist()], pa.bool_()))
    return run

