"""Stream queries on a table of several files, whose rows come in mixed order."""
import pytest
from pyspark.sql import functions as F

from webfold.plans.catalog import QUERIES

N = 120


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Each URL twice, N page ids apart; the same rows as one file and as four, the later ids first."""
    body = "<html><body><article>" + "<p>" + "some words of an article " * 60 + "</p></article></body></html>"
    pages = spark.range(2 * N).select(F.col("id").alias("page_id"), F.concat(F.lit("https://site"), F.col("id") % 3, F.lit(".com/blog/post-"), F.col("id") % N).alias("url"),
                                      F.lit(body).alias("html"))
    root = tmp_path_factory.mktemp("pages")
    pages.coalesce(1).write.parquet(f"{root}/one/pages.parquet")
    for k in (3, 1, 2, 0):
        pages.where(F.floor(F.col("page_id") / (2 * N // 4)) == k).coalesce(1).write.mode("append").parquet(f"{root}/four/pages.parquet")
    one = next((root / "one" / "pages.parquet").glob("part-*.parquet"))
    (root / "file").mkdir()
    (root / "file" / "pages.parquet").write_bytes(one.read_bytes())
    return root


def rows(spark, root, kind, name):
    return sorted(tuple(r) for r in QUERIES[name](spark, str(root / kind)).collect())


def test_each_url_once(spark, tables):
    got = rows(spark, tables, "four", "stream_dedup")
    assert len(got) == len(set(got)) == N
    assert got == rows(spark, tables, "file", "stream_dedup")


def test_counters_count_the_earliest_copy(spark, tables):
    got = rows(spark, tables, "four", "stream_counters")
    assert sum(r[3] for r in got) == N
    assert len({r[1] for r in got}) == N // 60  # page ids 0 to N - 1, a minute each
    assert got == rows(spark, tables, "file", "stream_counters")


def test_every_page_in_the_manifest(spark, tables):
    got = rows(spark, tables, "four", "stream_manifest")
    assert len(got) == 2 * N
    assert got == rows(spark, tables, "file", "stream_manifest")
