"""Exact shingle-Jaccard join with a token-group matrix.

A document is the set of its five-word shingles.  Two link when
100 * intersection >= 80 * union.  The join finds every link between different
sets up to connectivity, and no set of a group is compared with all others:

1. *Profiles* (one scan): set size, 128-bit digest of the set, four min-hash
   values, and a Misra-Gries summary of frequent tokens per partition.
   Documents of equal sets become one node.
2. *Groups*: nodes that share two min-hash values meet in blocks (dealt by a
   hash, bounded in members and tokens), are compared exactly, and linked
   nodes form groups.  This only gathers links cheaply; it decides nothing.
3. *Token-group matrix*: a node's tokens in one global order (rare before
   frequent, then by hash), cut after the first n - ceil(0.8 n) + 1.  The
   matrix has a row per (token, group): each group's union of these tokens,
   with its smallest and largest set.  A query node counts the tokens x that
   it shares with each foreign group.  All common tokens up to the earlier of
   two cuts lie in both prefixes, so no member can share more than
   x + max(ceil(0.8 n_q), ceil(0.8 n_s)) - 1 tokens with the query; a group
   whose bound is below 4/9 (n_q + n_s), what the similarity asks for, stays
   closed.
4. Groups that qualify are opened: the query is compared exactly with their
   members of fitting size.
5. Links found there join groups; connected components give the classes.

Frequent tokens (at most ``MAX_FREQUENT``, broadcast) come last in the order,
so a passage that many documents share is not in their prefixes; a frequent
token that the summary misses costs time, not links.  Tokens are 64-bit hashes
of a shingle's bytes.

Defined results: null and empty texts have no shingles, link with nothing and
are their own class; rows repeating an id and a text are copies of each other;
a null id is never a class id unless all its class has null ids; an empty table
gives no rows.  Only id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, group_sum, shared_folder, sized, slices
from .graph import components
from .shingles import shingles

SEEDS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89], np.uint64)  # any four
BLOCK_NODES, BLOCK_TOKENS = 48, 1_000_000
MAX_FREQUENT, LEAST_FREQUENT = 1 << 17, 8
_SUMMARY, _CHUNK = 1 << 14, 1_000_000


def prefix_length(n: int) -> int:
    return n - -(-80 * n // 100) + 1 if n else 0


def set_digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _keys(tokens: np.ndarray) -> list[int]:
    low = np.array([(tokens.view(np.uint64) ^ s).min() for s in SEEDS])
    return (low[[0, 2, 0, 1]] * np.uint64(0x9E3779B97F4A7C15) + low[[1, 3, 2, 3]]).view(np.int64).tolist()


_PROFILE = pa.schema([("row", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("keys", pa.list_(pa.int64())),
                      ("tokens", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and one last row with the partition's frequent tokens."""
    tokens, counts, waiting, held = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

    def merged():
        t, c = group_sum(np.concatenate([tokens, *waiting]), np.concatenate([counts, np.ones(held, np.int64)]))
        if len(c) > _SUMMARY:
            c = c - np.partition(c, len(c) - _SUMMARY - 1)[len(c) - _SUMMARY - 1]
        return t[c > 0], c[c > 0]

    for batch in batches:
        sets = []
        for text in batch.column(1).to_pylist():
            s = shingles(text)
            sets.append((len(s), set_digest(s), _keys(s) if len(s) else None))
            waiting.append(s)
            held += len(s)
            if held > _CHUNK:
                tokens, counts = merged()
                waiting, held = [], 0
        none = [None] * len(sets)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in zip([*zip(*sets), none, none], list(_PROFILE)[1:]))], schema=_PROFILE)
    tokens, counts = merged()
    yield pa.RecordBatch.from_pylist([{"tokens": tokens, "counts": counts}], schema=_PROFILE)


def _attach(docs: DataFrame, info: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``info`` (rep, hash, ...) with the text of document ``rep`` (``hash``: 60 bits of its text's md5, so that equal
    ids with different texts do not meet): broadcast if few rows, else a shuffle join."""
    side = sized(info)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), _bits(F.md5(F.coalesce(F.col(text_col), F.lit("")))).alias("_md5"))
    return (texts.join(side, texts["_id"].eqNullSafe(side["rep"]) & (texts["_md5"] == side["hash"]))
            .select("_text", *[c for c in info.columns if c not in ("rep", "hash")]))


def _bits(md5_hex: Column) -> Column:
    return F.conv(F.substring(md5_hex, 1, 15), 16, 10).cast("bigint")


def _block_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [[], [], []]
        for text, node, digest, blocks in zip(*(c.to_pylist() for c in batch.columns)):
            s = shingles(text)
            if set_digest(s) == digest:
                for b in blocks:
                    rows[0].append(b)
                    rows[1].append(node)
                    rows[2].append(s.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary())],
                                         names=["block", "node", "set"])


def linked(common: np.ndarray | int, n: np.ndarray | int, m: np.ndarray | int):
    return 100 * common >= 80 * (n + m - common)


def _link_block(table: pa.Table) -> pa.Table:
    """Exact comparison of a block's sets; (a, b) joins each member to the smallest of its local component."""
    nodes, first = np.unique(table["node"].to_numpy(), return_index=True)
    sets = [np.frombuffer(table["set"][int(k)].as_py(), np.int64) for k in first]
    sizes = np.array([len(s) for s in sets])
    _, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    several = counts[at] > 1
    column = (np.cumsum(counts > 1) - 1)[at[several]]
    owner = owner[several]
    common = np.zeros((len(sets), len(sets)), np.int64)
    for low in range(0, int(column.max(initial=-1)) + 1, 1 << 15):
        here = (column >= low) & (column < low + (1 << 15))
        m = np.zeros((len(sets), 1 << 15), np.float32)
        m[owner[here], column[here] - low] = 1
        common += (m @ m.T).astype(np.int64)
    label = np.arange(len(sets))
    links = linked(common, sizes[:, None], sizes[None, :])
    np.fill_diagonal(links, True)
    while True:  # smallest label over all links, until nothing changes
        new = np.where(links, label[None, :], len(sets)).min(axis=1)
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(sets))
    return pa.table({"a": pa.array(nodes[moved], pa.int64()), "b": pa.array(nodes[label[moved]], pa.int64())})


def _prefixes(frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, level = frequent.value
        for batch in slices(batches):
            parts, info = [], []
            for text, node, digest, group, n in zip(*(c.to_pylist() for c in batch.columns)):
                s = shingles(text)
                if not len(s) or set_digest(s) != digest:
                    continue
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
                    rank = np.where(hot[at] == s, level[at], 0)
                    if rank.any():
                        s = s[np.lexsort((s, rank))]
                s = s[:prefix_length(n)]
                parts.append(s)
                info.append((len(s), node, group, n))
            counts, node, group, n = (np.array(x, np.int64) for x in (zip(*info) if info else [[]] * 4))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(parts) if parts else [], pa.int64()), *(pa.array(np.repeat(x, counts)) for x in (node, group, n))],
                names=["token", "node", "grp", "n"])
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [(node, s.tobytes()) for text, node, digest in zip(*(c.to_pylist() for c in batch.columns)) if set_digest(s := shingles(text)) == digest]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["node", "set"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
            keep.append(bool(linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _rest(n: Column) -> Column:
    """Tokens after the cut: ceil(0.8 n) - 1."""
    return F.ceil(n * 80 / 100) - 1


def _may_link(x: Column, q: Column, s: Column) -> Column:
    """Can x shared prefix tokens make a link of sets of q and s tokens?  9 * overlap >= 4 * (q + s)."""
    return 9 * (x + F.greatest(_rest(q), _rest(s))) >= 4 * (q + s)


def text_md5(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def join_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: doc_id, md5 (of the text), n_shingles, component (a number per class), component_id (its smallest doc_id)."""
    spark = docs.sparkSession
    named = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), text_md5(F.col(text_col)).alias("md5"))
    kind = named.schema["doc_id"].dataType.simpleString()

    def profile(batches):
        ids = []

        def texts():
            for b in slices(batches):
                ids.append((b.column(1), b.column(3)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2)], names=["row", "text"])
        for out in _profiles(texts()):
            yield pa.RecordBatch.from_arrays([*(ids.pop(0) if ids else (pa.nulls(1, id_type), pa.nulls(1, pa.binary()))), *out.columns], names=["doc_id", "md5", *out.schema.names])
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(named.schema["doc_id"].dataType)
    profiles = cut(named.mapInArrow(profile, f"doc_id {kind}, md5 binary, row bigint, n bigint, digest binary, keys array<bigint>, tokens array<bigint>, counts array<bigint>"))
    rows = profiles.where("row IS NOT NULL").select("doc_id", "md5", "row", "n", "digest", "keys")
    # the smallest id that is not null, if there is one, and the text of its row
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("rep"), _bits(F.hex("md5")).alias("hash"))).alias("at")
    nodes = cut(rows.where("n > 0").groupBy("digest").agg(F.min("row").alias("node"), first, F.first("n").alias("n"), F.first("keys").alias("keys"))
                .select("digest", "node", "at.rep", "at.hash", "n", "keys"))

    # groups
    keyed = nodes.select("node", "n", F.posexplode("keys").alias("k", "key"))
    buckets = keyed.groupBy("k", "key").agg(F.count("*").alias("nodes"), F.sum("n").alias("tokens")).where("nodes > 1")
    blocks = (keyed.join(buckets, ["k", "key"])
              .select("node", F.xxhash64("k", "key", F.pmod(F.xxhash64("node", "k"), F.greatest(
                  F.ceil(F.col("nodes") / BLOCK_NODES), F.ceil(F.col("tokens") / BLOCK_TOKENS)))).alias("block"))
              .groupBy("node").agg(F.collect_list("block").alias("blocks")))
    members = cut(nodes.select("rep", "hash", "node", "digest").join(blocks, "node").select("rep", "hash", "node", "digest", "blocks"))
    near = (_attach(docs, members, id_col, text_col).mapInArrow(_block_members, "block bigint, node bigint, set binary")
            .groupBy("block").applyInArrow(_link_block, "a bigint, b bigint"))
    grouped = components(near)
    sizes = grouped.groupBy("label").agg(F.count("*").alias("size"))
    # a group of several nodes has a negative number, so that single nodes query them and not the reverse
    several = cut(grouped.join(sizes, "label").where("size > 1").select("node", (-1 - F.col("label")).alias("grp")))
    located = cut(nodes.select("rep", "hash", "node", "digest", "n").join(several, "node", "left")
                  .select("rep", "hash", "node", "digest", F.coalesce("grp", "node").alias("grp"), "n"))

    # token-group matrix
    frequent = (profiles.where("tokens IS NOT NULL").select(F.explode(F.arrays_zip("tokens", "counts")).alias("t"))
                .groupBy("t.tokens").agg(F.sum("t.counts").alias("c")).where(F.col("c") >= LEAST_FREQUENT)
                .orderBy(F.desc("c"), "tokens").limit(MAX_FREQUENT).collect())
    hot = sorted((r.tokens, int(r.c).bit_length()) for r in frequent)
    sent = spark.sparkContext.broadcast((np.array([t for t, _ in hot], np.int64), np.array([c for _, c in hot], np.int64)))
    # written once, so that both sides of the join below read one table and share one exchange
    path = shared_folder(spark, "prefixes")
    _attach(docs, located, id_col, text_col).mapInArrow(_prefixes(sent), "token bigint, node bigint, grp bigint, n bigint").write.parquet(path)
    prefix = spark.read.parquet(path).repartition("token")
    # "any" keeps this side's columns those of the query side
    matrix = prefix.groupBy("token", "grp").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("node").alias("any"))
    q = prefix.select("token", "node", F.col("grp").alias("own"), "n")
    shared = (q.join(matrix, (q["token"] == matrix["token"]) & (q["own"] > matrix["grp"]) & (q["node"] != matrix["any"])
                     & (100 * matrix["high"] >= 80 * q["n"]) & (80 * matrix["low"] <= 100 * q["n"]))
              .groupBy("node", "grp").agg(F.count("*").alias("x"), F.first("n").alias("n"), F.first("low").alias("low"), F.first("high").alias("high"),
                                          F.min("low").alias("least"), F.max("high").alias("most"), F.first("own").alias("own")))
    n = F.col("n")
    smallest = F.greatest(F.col("least"), F.ceil(n * 80 / 100))
    largest = F.least(F.col("most"), F.floor(n * 100 / 80))
    # below n the bound is best at the smallest size; above, it rises by 5 but falls by 4 from 5k-1 to 5k, so it is best at the largest or one less
    opened = shared.where(_may_link(F.col("x"), n, F.least(smallest, n)) | _may_link(F.col("x"), n, F.greatest(largest, n))
                          | _may_link(F.col("x"), n, F.greatest(largest - 1, n))).select("node", "own", "n", "grp")
    inside = located.select(F.col("node").alias("other"), F.col("n").alias("m"), "grp")
    pairs = cut(opened.join(inside, "grp").where((100 * F.col("m") >= 80 * n) & (80 * F.col("m") <= 100 * n)).select("node", "own", "other", "grp"))

    # exact comparison
    used = pairs.select("node").unionByName(pairs.select(F.col("other").alias("node"))).distinct()
    sets = _attach(docs, cut(located.select("rep", "hash", "node", "digest").join(used, "node", "left_semi").select("rep", "hash", "node", "digest")), id_col, text_col)
    sets = cut(sets.mapInArrow(_sets, "node bigint, set binary").dropDuplicates(["node"]))
    links = (pairs.join(sets.withColumnRenamed("set", "x"), "node")
             .join(sets.select(F.col("node").alias("other"), F.col("set").alias("y")), "other")
             .select(F.col("own").alias("a"), F.col("grp").alias("b"), "x", "y").mapInArrow(_verified, "a bigint, b bigint"))
    joined = components(links)
    classes = (located.join(sized(cut(joined.select(F.col("node").alias("grp"), "label"))), "grp", "left")
               .select("digest", "rep", F.coalesce("label", "grp").alias("component")))
    smallest_id = classes.groupBy("component").agg(F.min("rep").alias("component_id"))
    classes = cut(classes.join(smallest_id, "component").select("digest", "component", "component_id"))
    return (rows.join(sized(classes), "digest", "left")
            .select("doc_id", "md5", F.col("n").alias("n_shingles"), F.coalesce("component", -1 - F.col("row")).alias("component"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id."""
    return join_sets(docs).select("doc_id", "n_shingles", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is their class's smallest, with all columns; rows without shingles all stay."""
    gone = join_sets(docs, id_col, text_col).where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    side = sized(cut(gone.select(F.col("doc_id").alias("_gone"), F.col("md5").alias("_md5")).distinct()))
    same = docs[id_col].eqNullSafe(side["_gone"]) & (text_md5(docs[text_col]) == side["_md5"])
    return docs.join(side, same, "left_anti")
