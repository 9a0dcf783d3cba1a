"""End-to-end: a small fake site as captured pages; two articles are kept."""
from pyspark.sql import functions as F

from webfold.operators.extract import extract_articles, page_errors
from webfold.operators.frontier import crawl_frontier, validate_jobs
from webfold.operators.links import page_links
from webfold.operators.pages import content_dedup, crawled_pages, manifest_rows

WORDS = " ".join(["lorem"] * 30)


def article(title, extra=""):
    return (f"<html lang='en'><head><title>{title}</title><meta name='author' content='Ann'>"
            f"<script>var t='</p>';</script></head><body><nav><a href='/tag/x/'>tag</a></nav>"
            f"<article><h1>{title}</h1><p>{WORDS} <b>bold</b> &amp; more.</p>{extra}</article>"
            f"<footer>foot</footer></body></html>")


HOME = ("<html><body><a href='/blog/first-post'>1</a><a href='/blog/second-post/?utm_source=x'>2</a>"
        "<a href='/about'>about</a><a href='/category/tech/'>c</a><a href='/tag/go/'>t</a>"
        "<a href='/wp-admin/'>a</a><a href='https://other.com/x'>x</a><p>short</p></body></html>")


def fake_site(spark):
    rows = [(1, "https://example.com/", HOME),
            (2, "https://example.com/blog/first-post", article("First post")),
            (3, "https://example.com/blog/second-post", article("Second post", "<ul><li>item</li></ul>")),
            (4, "https://example.com/about", "<html><body><p>About us</p></body></html>")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_extraction_contract(spark):
    ex = extract_articles(fake_site(spark)).filter("page_id = 2").first()
    assert ex.title == "First post" and ex.byline == "Ann" and ex.language == "en"
    assert ex.word_count == 2 + 30 + 3  # h1 "First post" + 30 words + "bold & more."
    assert "</p>" not in ex.text_content and "foot" not in ex.text_content


def test_manifest_keeps_articles(spark):
    m = manifest_rows(extract_articles(fake_site(spark)), min_word_count=20).collect()
    assert sorted(r.url for r in m) == ["https://example.com/blog/first-post", "https://example.com/blog/second-post"]
    assert all(r.status == "ok" and r.relative_path.startswith("pages/example.com/blog/") for r in m)


def test_crawled_page_markdown(spark):
    cp = crawled_pages(extract_articles(fake_site(spark)), min_word_count=20).filter("page_id = 3").first()
    md = cp.markdown_content
    assert md.startswith('---\nurl: "https://example.com/blog/second-post"\n')
    assert "# Second post" in md and "**bold**" in md and "- item" in md and md.endswith("\n")


def test_frontier_scope_and_blacklist(spark):
    pages = fake_site(spark)
    jobs = validate_jobs(spark.createDataFrame(
        [("j", "example.com", ["example.com", "www.example.com"], 50, 3, "links")],
        "job_id string, domain string, allowed_domains array<string>, max_pages int, max_depth int, discovery_mode string"))
    links = page_links(pages).select("src_url", "position", "dst_url")
    fetched = pages.select("url")
    fr = crawl_frontier(jobs, links, fetched, None).collect()
    urls = {r.url for r in fr}
    assert urls == {"https://example.com/", "https://example.com/blog/first-post",
                    "https://example.com/blog/second-post", "https://example.com/about"}


def test_invalid_jobs(spark):
    jobs = spark.createDataFrame([("a", "e.com", 1, 1, "BOTH"), ("b", "e.com", -1, 1, "links"),
                                  ("c", "e.com", 1, 1, "rss")],
                                 "job_id string, domain string, max_pages int, max_depth int, discovery_mode string")
    r = {x.job_id: x.reject_reason for x in validate_jobs(jobs).collect()}
    assert r["a"] is None and r["b"].startswith("max_pages") and r["c"].startswith("invalid discovery mode")


def test_errors_and_dedup(spark):
    pages = spark.createDataFrame([(1, "://", "<p>x</p>"), (2, "https://e.com/a", None), (3, "https://e.com/b", "<p>x</p>")],
                                  "page_id long, url string, html string")
    errs = {r.page_id: r.phase for r in page_errors(pages).collect()}
    assert errs == {1: "normalize", 2: "fetch"}
    docs = spark.createDataFrame([(1, "h1"), (2, "h1"), (3, "h2")], "page_id long, content_hash string")
    assert sorted(r.page_id for r in content_dedup(docs).collect()) == [1, 3]
