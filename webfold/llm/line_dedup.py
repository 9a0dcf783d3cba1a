"""Near-duplicate lines by a deletion-neighbourhood join, in DataFrame functions only.

A line is near another if their word sequences differ by at most one word
inserted, deleted or replaced, and both have at least ``MIN_WORDS`` words;
shorter lines match only when equal.  A line goes if an equal or near line
stands earlier (by doc_id, then text hash, then place); blank lines stay.

1. Lines become narrow rows: a 128-bit key of their words and up to four hashes
   of halves.  Equal lines are one row after an aggregation with map-side
   combine, whatever their number.
2. Of two sequences one word apart, the first half or the rest is the same (the
   halves are those of the shorter).  So only lines that share a half's hash
   with another line go on; this loses nothing and spares the variants of all
   lines that have no neighbour.
3. A line of n words emits itself and its n variants with one word left out, as
   hashes.  Variants are hashed by two 44-bit sums over (word, place), so
   prefix sums give all n of them in O(n) for a line of any length.
4. Lines that meet at a variant with the same gap differ in that word alone,
   all of them mutually; a variant equal to a whole line is that line and one
   word more.  So each variant needs only its earliest line, one row a line
   (no pairs within a group), and joining it back gives (line, earlier line).
5. Each such pair is verified on the words (equal up to one gap) before the
   line goes.

Defined results: null text has no lines and stays null; null ids come first in
the order; rows repeating an id and a text are one document and get the same
result; an empty table gives no rows.  Only id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, sized

MIN_WORDS = 4


def _words(line: Column) -> Column:
    """Runs of anything but ASCII white space."""
    odd = line.contains("\t") | line.contains("\r") | line.contains("\x0b") | line.contains("\x0c")
    return F.array_remove(F.split(F.when(odd, F.translate(line, "\t\r\x0b\x0c", "    ")).otherwise(line), " "), "")


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, digest (of the text), place and line."""
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("digest"))
            .select("doc_id", "digest", F.posexplode(F.split("text", "\n")).alias("place", "line")))


def _half(words: Column, shorter: Column, begin: bool) -> Column:
    """Hash of the first half of ``shorter`` words, or of as many at the end as are left."""
    n = F.size(words)
    first = F.floor(shorter / 2).cast("int")
    rest = (shorter - first).cast("int")
    return F.xxhash64(F.lit("first"), first, F.slice(words, F.lit(1), first)) if begin else F.xxhash64(F.lit("rest"), rest, F.slice(words, n - rest + 1, rest))


def _part(word: Column, place: Column, seed: int) -> Column:
    """44 bits of a word at a place: sums of up to half a million stay within a long."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), place, word), 20)


def _variants(lines: DataFrame) -> DataFrame:
    """(line, size, gap, h1, h2): each line with one word left out, and whole (gap 0).  ``lines`` is partitioned by line."""
    at = F.col("at")
    each = lines.select("line", F.size("words").alias("n"), F.posexplode("words").alias("at", "word"))
    whole = Window.partitionBy("line")
    up_to_here = whole.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    kept, shifted = {}, {}
    for s in (1, 2):
        here, left = _part(F.col("word"), at, s), _part(F.col("word"), at - 1, s)
        each = each.withColumn(f"g{s}", here).withColumn(f"s{s}", left)
        kept[s] = F.sum(f"g{s}").over(up_to_here)
        shifted[s] = F.sum(f"s{s}").over(whole) - F.sum(f"s{s}").over(up_to_here)
    sums = each.select("line", "n", "at", *[(kept[s] - F.col(f"g{s}") + shifted[s]).alias(f"h{s}") for s in (1, 2)], *[kept[s].alias(f"w{s}") for s in (1, 2)])
    gone = F.struct((F.col("n") - 1).alias("size"), (at + 1).alias("gap"), F.col("h1"), F.col("h2"))
    itself = F.struct(F.col("n").alias("size"), F.lit(0).alias("gap"), F.col("w1").alias("h1"), F.col("w2").alias("h2"))
    return (sums.select("line", F.explode(F.when(at == F.col("n") - 1, F.array(gone, itself)).otherwise(F.array(gone))).alias("v"))
            .select("line", "v.*"))


def _within_one(a: Column, b: Column) -> Column:
    """Do two word arrays differ by at most one word?  Their common beginning and end cover all but one of the longer."""
    n, m = F.size(a), F.size(b)
    short = F.least(n, m)
    longest = F.greatest(n, m)
    numbers = F.sequence(F.lit(1), short)
    first = F.coalesce(F.array_min(F.filter(numbers, lambda i: F.get(a, i - 1) != F.get(b, i - 1))), short + 1) - 1
    last = F.coalesce(F.array_min(F.filter(numbers, lambda i: F.get(a, n - i) != F.get(b, m - i))), short + 1) - 1
    return (F.abs(n - m) <= 1) & (first + last >= longest - 1)


def near_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lines, repeated): every line's place and key; and each key that more than one line has or that goes as near, with its first place."""
    words = F.col("words")
    n = F.size(words)
    parts = {"a": _half(words, n, True), "b": _half(words, n, False), "c": _half(words, n - 1, True), "d": _half(words, n - 1, False)}
    lines = cut(_lines(docs, id_col, text_col).withColumn("words", _words(F.col("line"))).where(n > 0)
                .select("doc_id", "digest", "place", F.unhex(F.md5(F.array_join("words", " "))).alias("key"),
                        *[F.when(n >= MIN_WORDS, x).alias(c) for c, x in parts.items()]))
    firsts = cut(lines.groupBy("key", *parts).agg(F.min(F.struct("doc_id", "digest", "place")).alias("first"), F.count("*").alias("lines")))

    # lines that share half their words with another; numbered in the order of their first places
    halves = firsts.where("a IS NOT NULL").select("key", F.explode(F.array_distinct(F.array(*parts))).alias("half"))
    met = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    may = cut(firsts.select("key", "first").join(halves.join(sized(cut(met)), "half", "left_semi").select("key").distinct(), "key", "left_semi")
              .orderBy("first").withColumn("line", F.monotonically_increasing_id()))
    places = sized(may.select("line", "first.*"))
    found = _lines(docs, id_col, text_col).withColumnRenamed("line", "source")
    same = [found[c].eqNullSafe(places[c]) for c in ("doc_id", "digest", "place")]
    wordlists = cut(found.join(places, same[0] & same[1] & same[2]).select(places["line"], _words(F.col("source")).alias("words")).dropDuplicates(["line"]))

    variants = cut(_variants(wordlists.repartition("line")))
    group = ["size", "h1", "h2"]
    # one word replaced: the same gap
    replaced = (variants.where("gap > 0").groupBy(*group, "gap").agg(F.min("line").alias("other"), F.count("*").alias("n")).where("n > 1")
                .select(*group, "gap", "other"))
    pairs = variants.join(sized(cut(replaced)), [*group, "gap"]).select("line", "other")
    # one word more: a whole line, and a variant of another
    whole = sized(variants.where("gap = 0").select(*group, F.col("line").alias("whole")))
    longer = cut(variants.where("gap > 0").join(whole, group).select("line", "whole"))
    pairs = (pairs.unionByName(longer.select("line", F.col("whole").alias("other")))
             .unionByName(longer.groupBy("whole").agg(F.min("line").alias("other")).select(F.col("whole").alias("line"), "other"))
             .where("other < line").distinct())
    near = (pairs.join(wordlists.select("line", F.col("words").alias("x")), "line").join(wordlists.select(F.col("line").alias("other"), F.col("words").alias("y")), "other")
            .where(_within_one(F.col("x"), F.col("y"))).select("line").distinct())
    goes = cut(may.join(near, "line", "left_semi").select("key", F.lit(True).alias("near")))
    repeated = (firsts.select("key", "first", "lines").join(sized(goes), "key", "left").where("lines > 1 OR near")
                .select("key", "first", F.coalesce("near", F.lit(False)).alias("near")))
    return lines.select("doc_id", "digest", "place", "key"), sized(cut(repeated))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: doc_id, n_lines (with words), n_kept, text without the lines that go."""
    lines, repeated = near_lines(docs, id_col, text_col)
    here = F.struct("doc_id", "digest", "place")
    gone = (lines.join(repeated, "key").where(F.col("near") | ~here.eqNullSafe(F.col("first")))
            .groupBy("doc_id", "digest").agg(F.collect_set("place").alias("gone"))
            .select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "gone"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("digest"))
    joined = texts.join(gone, texts["doc_id"].eqNullSafe(gone["_id"]) & (texts["digest"] == gone["_digest"]), "left")
    # the guard keeps the split out of what reads it, so that a text is split once and not once a line
    joined = joined.withColumn("every", F.when(F.spark_partition_id() >= 0, F.split("text", "\n")))
    every = F.col("every")
    stays = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), "gone")  # a hash set, so linear in the lines
    kept = F.transform(stays, lambda place: F.get(every, place))
    n_lines = F.coalesce(F.size(F.filter(every, lambda x: x.rlike("[^ \t\r\x0b\x0c]"))), F.lit(0))
    return joined.select(
        "doc_id", n_lines.cast("bigint").alias("n_lines"), (n_lines - F.coalesce(F.size("gone"), F.lit(0))).cast("bigint").alias("n_kept"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"))
