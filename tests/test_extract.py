from pyspark.sql import functions as F

from webfold.operators.extract import capture_gate, extract_articles, page_errors
from webfold.operators.pages import crawled_pages
from webfold.operators.quality import quality_scores, template_blocks, without_template_blocks


def text_of(spark, html):
    df = spark.createDataFrame([(1, "https://garden.test/x", html)], "page_id long, url string, html string")
    return extract_articles(df).first().text_content


def test_nested_and_sibling_articles_lose_nothing(spark):
    assert text_of(spark, "<body>no<article>a <article>b</article> c</article>no</body>") == "a\nb\nc"
    assert text_of(spark, "<body>no<article><p>a</article><article><p>b</article>no</body>") == "a\nb"


def test_open_elements_end_with_the_document(spark):
    assert text_of(spark, "<article><p>kept</p><script>var x = 'lost") == "kept"
    assert text_of(spark, "<p>kept<!-- lost") == "kept"


def test_references_of_the_whole_html_table(spark):
    assert text_of(spark, "<article>M&uuml;nchen &rarr; K&ouml;ln &#x1F33B;</article>") == "München → Köln 🌻"


CAPTURES = [(1, 200, "text/html; charset=utf-8"), (2, 404, "text/html"), (3, None, None), (4, 200, "application/json"), (5, 204, "APPLICATION/XHTML+XML"), (6, 301, ""), (7, 200, "")]


def captures(spark):
    rows = [(i, f"https://garden.test/{i}", f"<article>{'word ' * 30}</article>", s, c) for i, s, c in CAPTURES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, status_code int, content_type string")


def test_gate_before_extraction(spark):
    kept = capture_gate(captures(spark))
    assert sorted(r.page_id for r in kept.collect()) == [1, 3, 5, 7]
    out = crawled_pages(extract_articles(kept, keep=("page_id", "status_code", "content_type")), 20).collect()
    assert {r.page_id: (r.http_status, r.content_type) for r in out} == {i: (s, c) for i, s, c in CAPTURES if i in (1, 3, 5, 7)}
    assert {r.page_id: r.phase for r in page_errors(captures(spark)).collect()} == {2: "fetch", 4: "filter", 6: "fetch"}


def test_templates_are_found_and_removed(spark):
    rows = [(i, f"https://garden.test/{i}", f"<p>Menu line</p><p>own {i}</p><p>{'rare' if i else 'once'}</p>") for i in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted((r.n_pages, r.host_pages) for r in template_blocks(pages).collect()) == [(3, 4), (4, 4)]
    assert {r.page_id: r.text for r in without_template_blocks(pages).collect()} == {0: "own 0\nonce", 1: "own 1", 2: "own 2", 3: "own 3"}


def test_quality_is_one_scan(spark):
    pages = spark.createDataFrame([(1, "https://garden.test/blog/x", "<article>" + "word " * 300 + "</article>"), (2, "https://garden.test/y", "<a href=z>link</a>")],
                                  "page_id long, url string, html string")
    got = {r.page_id: r.quality_score for r in quality_scores(pages).collect()}
    assert got == {1: 2 + 3 + 1 + 1 + 1, 2: 1}
    plan = quality_scores(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
