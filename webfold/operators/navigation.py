"""E5: lines of Markdown told apart as navigation or prose; menus refused or taken out.

A line is navigation if, behind its list or quote mark, it holds nothing but
links, or is short (under ``SHORT`` words) and ends like no sentence.  Headings, blank lines and table
rules are neither; code counts as prose.  All of it is JVM expressions on one row, linear in the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webfold.constants import WS

SHORT = 4
MARK = r"^[ \t>]*(?:(?:[-*+]|[0-9]+\.) +)?"
ONLY_LINKS = r"^(?:!?\[[^\]]*\]\([^)]*\)[ \t|,/·•»>-]*)+\z"
NEITHER = r"^[ \t>]*(?:#{1,6} .*|(?:\* ){2}\*|```+|\|[ |:-]*)?\z"
SENTENCE_END = r"""[.!?:;…。！？]["'”’)\]*_]*\z"""
TARGET = r"\]\([^)]*\)"


def _words(line: Column) -> Column:
    return F.coalesce(F.regexp_count(F.regexp_replace(line, TARGET, "]"), F.lit(f"[^{WS}]+")), F.lit(0))


def line_kind(line: Column) -> Column:
    """'n' navigation, 'p' prose, 'b' neither."""
    bare = F.regexp_replace(line, MARK, "")
    short = (_words(bare) < SHORT) & ~bare.rlike(SENTENCE_END)
    return F.when(line.rlike(NEITHER), "b").when(bare.rlike(ONLY_LINKS) | short, "n").otherwise("p")


def _with_lines(df: DataFrame, markdown: str) -> DataFrame:
    """``_lines``: (line, kind) of each line outside code.  The guard keeps it from being inlined into what reads it."""
    outside = F.array_join(F.filter(F.split(F.coalesce(F.col(markdown), F.lit("")), "```", -1), lambda x, i: i % 2 == 0), "\n")
    lines = F.transform(F.split(outside, "\n", -1), lambda x: F.struct(x.alias("line"), line_kind(x).alias("kind")))
    return df.withColumn("_lines", F.when(F.spark_partition_id() >= 0, lines))


def navigation_like(df: DataFrame, markdown: str = "markdown", min_share_pct: int = 50, min_words: int = 10) -> DataFrame:
    """``df`` with n_nav_lines, nav_words, prose_words and is_navigation: less prose than ``min_words``, or than its
    share of all words."""
    def words(kind: str) -> Column:
        return F.aggregate(F.filter("_lines", lambda x: x["kind"] == kind), F.lit(0), lambda n, x: n + _words(F.regexp_replace(x["line"], MARK, "")))
    code = F.array_join(F.filter(F.split(F.coalesce(F.col(markdown), F.lit("")), "```", -1), lambda x, i: i % 2 == 1), " ")
    out = _with_lines(df, markdown).withColumns({
        "n_nav_lines": F.size(F.filter("_lines", lambda x: x["kind"] == "n")), "nav_words": words("n"), "prose_words": words("p") + _words(code)}).drop("_lines")
    few = (F.col("prose_words") < min_words) | (F.col("prose_words") * 100 < (F.col("prose_words") + F.col("nav_words")) * min_share_pct)
    return out.withColumn("is_navigation", few)


def without_navigation_runs(df: DataFrame, markdown: str = "markdown", run: int = 3) -> DataFrame:
    """``df`` with ``run`` or more navigation lines in a row taken out of the Markdown; texts with code stay as they are."""
    lines = F.col("_lines")

    def in_run(i: Column) -> Column:
        ways = []
        for first in range(run):  # the line as the first, second, ... of ``run`` in a row
            way = F.lit(True)
            for k in range(run):
                way = way & (F.coalesce(F.get(lines, i + (k - first))["kind"], F.lit("b")) == "n")
            ways.append(way)
        out = ways[0]
        for way in ways[1:]:
            out = out | way
        return out
    kept = F.array_join(F.transform(F.filter(F.transform(lines, lambda x, i: F.struct(x["line"].alias("line"), in_run(i).alias("gone"))), lambda x: ~x["gone"]), lambda x: x["line"]), "\n")
    tidy = F.regexp_replace(F.regexp_replace(kept, r"\n{3,}", "\n\n"), f"^[{WS}]+|[{WS}]+\\z", "")
    plain = ~F.coalesce(F.col(markdown).contains("```"), F.lit(True))
    return _with_lines(df, markdown).withColumn(markdown, F.when(plain, tidy).otherwise(F.col(markdown))).drop("_lines")
