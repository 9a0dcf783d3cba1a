"""Jobs as they are read, seeds by discovery mode, converters and event rows."""
import json

from pyspark.sql import functions as F

from webfold.operators.frontier import seeds, validate_jobs
from webfold.operators.pages import crawled_pages
from webfold.operators.quality import error_event_json, page_event_json, summary_event_json
from webfold.sources.tables import read_jobs


def test_jobs_take_defaults_where_a_limit_is_missing_or_no_number(spark, tmp_path):
    rows = [{"job_id": "a", "domain": "a.test", "max_pages": "7", "max_depth": "x", "discovery_mode": " Links "}, {"job_id": "b", "domain": "b.test"},
            {"job_id": "c", "domain": "", "max_pages": -1, "discovery_mode": "rss"}]
    (tmp_path / "jobs.json").write_text("\n".join(map(json.dumps, rows)))
    got = {r.job_id: (r.max_pages, r.max_depth, r.discovery_mode, r.reject_reason) for r in validate_jobs(read_jobs(spark, str(tmp_path))).collect()}
    assert got == {"a": (7, 4, "links", None), "b": (500, 4, "both", None), "c": (-1, 4, "rss", "max_pages must be >= 0")}


def test_seeds_by_discovery_mode(spark):
    jobs = spark.createDataFrame([(m, f"{m}.test", [f"{m}.test"], m) for m in ("sitemap", "links", "both")], "job_id string, domain string, allowed_domains array<string>, discovery_mode string")
    listed = spark.createDataFrame([(m, f"https://{m}.test/{p}", [k]) for m in ("sitemap", "links", "both") for k, p in enumerate(["b", "tag/x/", "a"])], "job_id string, loc string, ord array<int>")
    got = sorted((r.job_id, r.url.split("/", 3)[3], list(r.okey)) for r in seeds(jobs, listed).collect())
    assert got == [("both", "", [1]), ("both", "a", [0, 2]), ("both", "b", [0, 0]), ("links", "", [1]), ("sitemap", "a", [0, 2]), ("sitemap", "b", [0, 0])]
    assert sorted(r.job_id for r in seeds(jobs, None).collect()) == ["both", "links"]


def extracted(spark):
    df = spark.createDataFrame([(1, "https://s.test/x", "T", "", "", "en", "", "<p>one two</p>", "one two", "", 2)],
                               "page_id long, norm_url string, title string, byline string, site_name string, language string, canonical_url string, content_html string, text_content string, excerpt string, word_count int")
    return df.withColumn("published_time", F.lit(None).cast("timestamp"))


def test_a_converter_of_ones_own(spark):
    got = crawled_pages(extracted(spark), 1, converter=lambda df: df.withColumn("markdown", F.upper("text_content"))).first()
    assert got.markdown_content.endswith("---\n\nONE TWO\n")


def test_events(spark):
    page = json.loads(page_event_json(crawled_pages(extracted(spark), 1)).first().event_json)
    assert page["url"] == "https://s.test/x" and page["crawled_at"] == "2026-01-01T00:00:00Z" and not {"byline", "site_name", "excerpt", "published_time"} & set(page)
    errors = spark.createDataFrame([("j", "u", 0, "no body", "fetch"), ("j", "v", 404, "http status 404", "fetch")], "job_id string, url string, http_status int, error string, phase string")
    got = {r.url: json.loads(r.event_json) for r in error_event_json(errors, "2031-01-02 03:04:05").collect()}
    assert got["v"] == {"job_id": "j", "url": "v", "http_status": 404, "error": "http status 404", "phase": "fetch", "occurred_at": "2031-01-02T03:04:05Z"} and "http_status" not in got["u"]
    summary = spark.sql("SELECT 'j' AS job_id, 's.test' AS domain, 5L AS pages_extracted, 1L AS errors, timestamp'2031-01-01 00:00:00' AS started_at, timestamp'2031-01-01 00:01:00' AS finished_at")
    assert json.loads(summary_event_json(summary).first().event_json) == {
        "job_id": "j", "domain": "s.test", "pages_extracted": 5, "errors": 1, "started_at": "2031-01-01T00:00:00Z", "finished_at": "2031-01-01T00:01:00Z"}
