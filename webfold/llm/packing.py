"""Best-fit packing of token sequences by configurations priced as in their linear program.

Documents are tokenised where they lie and cut into pieces of at most
``capacity`` ids; only ids' counts and checksums go on.  The pieces' lengths
make a histogram of at most ``capacity`` counts, whatever the corpus' size.  Over it
stands the configuration LP (a variable per multiset of lengths that fits a
sequence, a covering constraint per length).  It is approached, not solved: the price of a
length is its size times a factor that falls exponentially with the share of its
demand already covered, the configuration of largest price is found by
unbounded-knapsack dynamic programming and taken at once in whole sequences, for
at most a fixed share of any demand.  No fractional cover is averaged, so there is no LP
value; the README tells how far the result is from the lower bound.  What the steps
leave is placed best-fit decreasing, again on the histogram.  The result is a list of (configuration, count) whose size depends
on ``capacity`` and ``rounds`` alone, so it is broadcast.

A piece finds its place by its rank among pieces of its length.  Ranks are
prefix sums of per-partition counts plus the rank inside (partition, length),
so no length, however common, meets in one task.

Defined results: null text is empty and gives one piece of the end id alone;
rows repeated whole are packed as separate documents; an empty table gives no
rows; only id and text columns are read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import cut, slices

CAPACITY = 1024
END_ID = 2
ROUNDS = 400

# fixed values: the pre-tokenisation pattern of byte-level BPE vocabularies
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of a byte-level vocabulary file: Latin-1 printables are themselves, others follow 255."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


@lru_cache(maxsize=2)
def encoder(path: str) -> tiktoken.Encoding:
    """The vocabulary of a byte-level BPE ``tokenizers`` file, whose ids rise in merge order, in the faster library."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    byte = _byte_alphabet()
    special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
    ranks = {bytes(byte[c] for c in w): i for w, i in file["model"]["vocab"].items() if w not in special}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def token_ids(enc: tiktoken.Encoding, text: str | None, end_id: int = END_ID) -> np.ndarray:
    """uint32 ids of the text, then the end id; special tokens written out in the text count as themselves."""
    if not text:
        return np.array([end_id], np.uint32)
    try:
        ids = enc.encode_to_numpy(text, allowed_special="all")
    except ValueError:  # its pattern's stack ends at a run of about a million white-space characters; ``tokenizers`` has no such limit
        ids = np.array(tokenizer(enc.name).encode(text, add_special_tokens=False).ids, np.uint32)
    return np.append(ids, np.uint32(end_id))


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full ones, but for a shorter first."""
    first = (n - 1) % capacity + 1
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in slices(batches):
            at, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                ids = token_ids(enc, text, end_id).astype("<u4")
                for j, (s, n) in enumerate(cuts(len(ids), capacity)):
                    at.append(k)
                    piece.append(j)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(ids[s:s + n].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), batch.column(2).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "row", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row, piece, start, length, ids_crc32, part (the partition it was made in)."""
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
            .mapInArrow(_pieces(tokenizer, capacity, end_id),
                        f"doc_id {kind}, row bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
            .withColumn("part", F.spark_partition_id()))


def price(value: np.ndarray, capacity: int) -> np.ndarray:
    """The multiset of lengths (counts by length) of largest total value that fits: unbounded knapsack.

    ``value[n]`` is a length's value (index 0 unused).  Shorter totals are
    allowed: best[c] starts at best[c-1].
    """
    lengths = np.flatnonzero(value > 0)
    gain = value[lengths]
    best = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, np.int64)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if k := upto[c]:
            total = best[c - lengths[:k]] + gain[:k]
            j = int(total.argmax())
            if total[j] > best[c]:
                best[c], taken[c] = total[j], lengths[j]
    config = np.zeros(capacity + 1, np.int64)
    c = capacity
    while c > 0:
        if taken[c]:
            config[taken[c]] += 1
            c -= taken[c]
        else:
            c -= 1
    return config


def solve(demand: np.ndarray, capacity: int, rounds: int = ROUNDS, share: float = 0.25, eta: float = 3.0) -> tuple[list[tuple[np.ndarray, int]], np.ndarray]:
    """Multiplicative-weights cover of ``demand`` by configurations, in whole sequences, and the demand left over.

    A length's weight is its size times exp(-eta * covered share): the size is
    the LP dual of a perfect fill, the exponential the penalty of the weights
    method.  Each step takes the priced configuration as often as covers at
    most ``share`` of any of its lengths' demand, and never above what is left.
    """
    left = demand.copy()
    plan: dict[bytes, int] = {}
    size = np.arange(capacity + 1) / capacity
    priced = demand > 0
    for _ in range(rounds):
        covered = 1 - left / np.maximum(demand, 1)
        config = price(np.where(priced & (left > 0), size * (1 + 0.05 * (np.exp(-eta * covered) - 0.5)), 0.0), capacity)
        used = np.flatnonzero(config)
        if not len(used):
            break
        short = used[config[used] > left[used]]
        if len(short):  # too few of a length are left for this step: they are rounding's
            priced[short] = False
            continue
        step = max(1, min(int((left[used] // config[used]).min()), int((demand[used] * share // config[used]).min())))
        left[used] -= step * config[used]
        key = config.astype(np.int64).tobytes()
        plan[key] = plan.get(key, 0) + step
    return [(np.frombuffer(k, np.int64), n) for k, n in plan.items()], left


def best_fit(left: np.ndarray, plan: list[tuple[np.ndarray, int]], capacity: int) -> list[tuple[np.ndarray, int]]:
    """Place the demand left over, longest first, into the open sequence with the least room, else a new one."""
    groups: dict[int, list[list]] = {}  # room -> [configuration, count]
    for config, n in plan:
        groups.setdefault(capacity - int((config * np.arange(capacity + 1)).sum()), []).append([config, n])
    for length in range(capacity, 0, -1):
        need = int(left[length])
        while need:
            room = min((r for r in groups if r >= length), default=None)
            if room is None:
                config, n, room = np.zeros(capacity + 1, np.int64), need, capacity
                n = -(-need // (capacity // length))
            else:
                config, n = groups[room].pop()
                if not groups[room]:
                    del groups[room]
            each = min(room // length, -(-need // n))
            fill = min(n, need // each)
            new = config.copy()
            new[length] += each
            groups.setdefault(room - each * length, []).append([new, fill])
            if n > fill and config.any():
                groups.setdefault(room, []).append([config, n - fill])
            need -= fill * each
    return [(c, n) for g in groups.values() for c, n in g if n]


def pack_histogram(demand: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[np.ndarray, int]]:
    """(counts by length, number of sequences) that together hold ``demand[n]`` pieces of each length n."""
    demand = demand.astype(np.int64)
    full = demand.copy()
    full[:capacity] = 0
    rest = demand - full
    plan, left = solve(rest, capacity, rounds)
    plan = best_fit(left, plan, capacity)
    if full[capacity]:
        plan.append((np.eye(1, capacity + 1, capacity, dtype=np.int64)[0], int(full[capacity])))
    return plan


def slots(plan: list[tuple[np.ndarray, int]], capacity: int = CAPACITY) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first sequence, pieces a sequence, offset of the first), ranks ascending."""
    out: dict[int, list] = {}
    ranks = np.zeros(capacity + 1, np.int64)
    sequence = 0
    for config, n in plan:
        offset = 0
        for length in np.flatnonzero(config).tolist():
            each = int(config[length])
            out.setdefault(length, []).append((int(ranks[length]), sequence, each, offset))
            ranks[length] += n * each
            offset += each * length
        sequence += n
    return {k: np.array(v, np.int64) for k, v in out.items()}


def _placed(places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            table = pa.Table.from_batches([batch])
            length, rank = table["length"].to_numpy(), table["rank"].to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length).tolist():
                at = np.flatnonzero(length == n)
                slot = places.value[n]
                s = slot[np.searchsorted(slot[:, 0], rank[at], "right") - 1]
                inside = rank[at] - s[:, 0]
                sequence[at] = s[:, 1] + inside // s[:, 2]
                offset[at] = s[:, 3] + inside % s[:, 2] * n
            table = table.drop_columns(["rank"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
            yield from table.to_batches()
    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, rounds: int = ROUNDS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cutted = cut(pieces(docs, tokenizer, capacity, end_id, id_col, text_col))
    counts = cut(cutted.groupBy("part", "length").agg(F.count("*").alias("n")))
    demand = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        demand[r.length] = r.n
    places = spark.sparkContext.broadcast(slots(pack_histogram(demand, capacity, rounds), capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part", "length").orderBy("row", "piece")
    ranked = (cutted.withColumn("inside", F.row_number().over(inside) - 1).join(base, ["part", "length"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("inside")).alias("rank")))
    kind = ranked.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(_placed(places), f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                             "sequence_id bigint, offset bigint")
