"""Navigation lines, menus and short articles; files that are written whole or not at all."""
import os

import pytest

from webfold.operators.navigation import navigation_like, without_navigation_runs
from webfold.sinks.files import export_markdown_files

MENU = "- [Home](https://s.test/)\n- [All our news](https://s.test/n)\n- About us\n  - [a](b) | [c](d)\n> Contact"
ARTICLE = "# Frost tonight\n\nCover the beds before dusk, and water the pots.\n\nMore at [the long guide to frost](https://s.test/g) for those who want it."


def test_a_menu_is_refused_and_a_short_article_is_not(spark):
    rows = [(1, MENU), (2, ARTICLE), (3, None), (4, ""), (5, ARTICLE + "\n\n" + MENU), (6, "```\nx = call(a, b)\nfor each of these do it again and again\n```"), (7, "# Only a long heading of eleven words stands in this text")]
    got = {r.k: (r.n_nav_lines, r.nav_words, r.prose_words, r.is_navigation) for r in navigation_like(spark.createDataFrame(rows, "k int, markdown string")).collect()}
    assert got == {1: (5, 10, 0, True), 2: (0, 0, 21, False), 3: (0, 0, 0, True), 4: (0, 0, 0, True), 5: (5, 10, 21, False), 6: (0, 0, 13, False), 7: (0, 0, 0, True)}


def test_runs_of_navigation_go(spark):
    rows = [(1, ARTICLE + "\n\n" + MENU + "\n\nThe end of it, at last."), (2, "- One thing\n- Two things\n\nA sentence that is long."), (3, MENU), (4, "```\na\nb\nc\n```"), (5, None)]
    got = {r.k: r.markdown for r in without_navigation_runs(spark.createDataFrame(rows, "k int, markdown string")).collect()}
    assert got == {1: ARTICLE + "\n\nThe end of it, at last.", 2: rows[1][1], 3: "", 4: rows[3][1], 5: None}


def test_a_text_of_many_lines_takes_linear_time(spark):
    from pyspark.sql import functions as F
    long = spark.range(1).select(F.repeat(F.lit("- [menu](x)\nA line of prose, that ends.\n"), 30_000).alias("markdown"))
    r = navigation_like(without_navigation_runs(long)).first()
    assert (r.n_nav_lines, r.prose_words) == (30_000, 180_000)


def tree(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, files in os.walk(folder) for f in files)


def test_files_are_written_whole(spark, tmp_path):
    rows = [(f"pages/s.test/{k}/x\n{k}.md", f"text {k} é\n") for k in range(9)] + [("pages/s.test/empty.md", None)]
    df = spark.createDataFrame(rows, "relative_path string, markdown_content string").repartition(4)
    for _ in range(2):
        export_markdown_files(df, str(tmp_path))
        assert tree(tmp_path) == sorted(p for p, _ in rows)
    assert all((tmp_path / p).read_text(encoding="utf-8") == (t or "") for p, t in rows)


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    rows = [(f"pages/s.test/{k}.md", "x" * 100_000) for k in range(8)] + [("../out.md", "outside")]
    df = spark.createDataFrame(rows, "relative_path string, markdown_content string").repartition(3)
    with pytest.raises(Exception, match="not a path below"):
        export_markdown_files(df, str(tmp_path / "base"))
    assert tree(tmp_path) == []
