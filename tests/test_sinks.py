import csv
import glob
import tempfile

import pytest

from webfold.operators.extract import extract_articles
from webfold.operators.pages import manifest_rows
from webfold.sinks.writers import manifest_format, write_errors, write_manifest, write_pages, write_summary

WORDS = " ".join(["word"] * 30)


def test_manifest_format():
    assert manifest_format(" CSV ") == "csv"
    with pytest.raises(NotImplementedError):
        manifest_format("sqlite")
    with pytest.raises(ValueError):
        manifest_format("xml")


def test_csv_manifest(spark):
    html = f'<html><head><title>A "quoted", title</title></head><body><article><p>{WORDS}</p></article></body></html>'
    pages = spark.createDataFrame([(1, "https://e.com/a?x=1", html)], "page_id long, url string, html string")
    out = tempfile.mkdtemp(prefix="webfold-test-")
    write_manifest(manifest_rows(extract_articles(pages), 10), out + "/m", "csv")
    files = glob.glob(out + "/m/*.csv")
    rows = [r for f in files for r in csv.reader(open(f, encoding="utf-8"))]
    # fixed values: the manifest's columns in order
    assert rows[0] == ["url", "canonical_url", "relative_path", "title", "word_count", "content_hash", "crawled_at", "status"]
    assert rows[1][0] == "https://e.com/a?x=1" and rows[1][3] == 'A "quoted", title' and rows[1][7] == "ok"
    assert rows[1][2].startswith("pages/e.com/a--") and rows[1][6] == "2026-01-01T00:00:00Z"


def test_pages_in_few_files_by_host_bucket(spark):
    rows = [(f"pages/h{k % 40}.test/p{k}.md", f"text {k}") for k in range(400)]
    df = spark.createDataFrame(rows, "relative_path string, markdown_content string")
    out = tempfile.mkdtemp(prefix="webfold-test-") + "/pages"
    write_pages(df, out, buckets=4)
    back = spark.read.parquet(out)
    assert sorted((r.relative_path, r.markdown_content) for r in back.collect()) == sorted(rows)
    assert all(len({r.bucket for r in back.collect() if r.host == f"h{k}.test"}) == 1 for k in range(40))
    assert len(glob.glob(out + "/bucket=*/*.parquet")) <= 4 + int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_errors_and_summary_round_trip(spark):
    out = tempfile.mkdtemp(prefix="webfold-test-")
    errors = spark.createDataFrame([(1, "https://e.test/a", 404, 'said "no", twice', "fetch")], "page_id long, url string, http_status int, error string, phase string")
    write_errors(errors.coalesce(1), out + "/errors")
    rows = [r for f in glob.glob(out + "/errors/*.csv") for r in csv.reader(open(f, encoding="utf-8"))]
    assert rows == [["page_id", "url", "http_status", "error", "phase"], ["1", "https://e.test/a", "404", 'said "no", twice', "fetch"]]
    summary = spark.createDataFrame([("j", 3)], "job_id string, pages_discovered long")
    write_summary(summary, out + "/summary")
    assert spark.read.parquet(out + "/summary").collect() == summary.collect()
