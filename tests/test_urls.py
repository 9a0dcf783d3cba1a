import pytest
from pyspark.sql import functions as F

from webfold.functions.urls import normalize_urls, relative_paths, resolve_urls, url_filters

NORMALIZE = [
    ("HtTp://Shop.Garden.TEST/Tools", "http://shop.garden.test/Tools"),
    ("https://garden.test/rake#handle", "https://garden.test/rake"),
    ("https://garden.test/rake?UTM_Source=mail&size=9", "https://garden.test/rake?size=9"),
    ("https://garden.test/rake?gclid=1&fbclid=2", "https://garden.test/rake"),
    ("https://garden.test/rake?w=3&h=7&h=1&b=", "https://garden.test/rake?b=&h=1&h=7&w=3"),
    ("https://garden.test/beds//raised///", "https://garden.test/beds//raised"),
    ("https://garden.test/", "https://garden.test/"),
    ("https://garden.test", "https://garden.test"),
    ("https://garden.test:8443/x?", "https://garden.test:8443/x?"),
    ("https://user:pw@Garden.test/x", "https://user:pw@garden.test/x"),
    ("https://garden.test/pflänzchen/", "https://garden.test/pfl%C3%A4nzchen"),
    ("https://garden.test/two words", "https://garden.test/two%20words"),
    ("https://garden.test/a(b)!", "https://garden.test/a(b)!"),
    ("https://garden.test/x?q=a+b&r=%7E*", "https://garden.test/x?q=a+b&r=~%2A"),
    ("https://garden.test/x?a;b&c=1", "https://garden.test/x?c=1"),
    ("https://garden.test:8o/x", None),
    ("https://garden.test/%g1", None),
    ("https://gar den.test/x", None),
    (":no-scheme", None),
    (None, None),
]

PATHS = [
    ("https://garden.test/beds/raised", "pages/garden.test/beds/raised.md"),
    ("https://garden.test", "pages/garden.test/index.md"),
    ("https://garden.test/beds/./raised", "pages/garden.test/beds/raised.md"),
    ("https://garden.test/a/b/../c", "pages/garden.test/a/c.md"),
    ("https://garden.test/../../../etc/passwd", "pages/garden.test/etc/passwd.md"),
    ("https://garden.test/a/../../../b", "pages/garden.test/b.md"),
    ("/only/a/path", None),
]


def test_normalize_vectors(spark):
    df = spark.createDataFrame(NORMALIZE, "u string, want string")
    for r in normalize_urls(df, "u", "got").collect():
        assert r.got == r.want, r.u


def test_normalize_is_idempotent(spark):
    df = normalize_urls(spark.createDataFrame(NORMALIZE, "u string, want string"), "u", "once")
    for r in normalize_urls(df, "once", "twice").collect():
        assert r.once == r.twice


def test_relative_paths_stay_in_the_host_folder(spark):
    df = normalize_urls(spark.createDataFrame(PATHS, "u string, want string"), "u", "n")
    for r in relative_paths(df, "n", "got").collect():
        assert r.got == r.want, r.u


def test_lossy_paths_carry_a_hash_of_the_url(spark):
    urls = ["https://garden.test/rake?a=1", "https://garden.test/rake?a=2", "https://garden.test/rake.html", "https://garden.test/rake"]
    df = normalize_urls(spark.createDataFrame([(u,) for u in urls], "u string"), "u", "n")
    got = [r.p for r in relative_paths(df, "n", "p").collect()]
    assert len(set(got)) == 4 and got[3] == "pages/garden.test/rake.md"
    assert all(g.startswith("pages/garden.test/rake--") and len(g) == len("pages/garden.test/rake--123456.md") for g in got[:3])


@pytest.mark.parametrize("path,allowed", [
    ("/beds/raised", True), ("/2031/11/frost", True), ("/tag/soil/", False), ("/Category/soil/", False), ("/wp-admin/x", False), ("/feed", False),
    ("/author/ann/", False), ("/search?q=hoe", False), ("/wp-content/uploads/hoe.png", False), ("/xmlrpc.php", False)])
def test_scope_and_blacklist(spark, path, allowed):
    rows = [(h + path, allowed and h != "https://elsewhere.test") for h in ("https://garden.test", "https://www.garden.test", "https://elsewhere.test")]
    df = spark.createDataFrame(rows, "u string, want boolean").withColumn("d", F.array(F.lit("garden.test"), F.lit("www.garden.test")))
    for r in url_filters(df, "u", "d").collect():
        assert r.allowed == r.want, r.u


def test_article_like_paths(spark):
    rows = [("/2031/11/frost", True), ("/blog/frost", True), ("/news/frost", True), ("/post/frost", True), ("/article/frost", True), ("/articles/frost", True),
            ("/prices", False), ("/", False)]
    df = spark.createDataFrame([("https://garden.test" + p, w) for p, w in rows], "u string, want boolean")
    for r in url_filters(df, "u").collect():
        assert r.likely_article == r.want, r.u


def test_resolve(spark):
    base = "https://garden.test/beds/raised/oak?x=1"
    cases = [("../pine", "https://garden.test/beds/pine"), ("/tools/./a/../b", "https://garden.test/tools/b"), ("?y=2", "https://garden.test/beds/raised/oak?y=2"),
             ("", base), ("//cdn.test/z", "https://cdn.test/z"), ("#top", None), ("mailto:ann@garden.test", "mailto:ann@garden.test"), ("ash", "https://garden.test/beds/raised/ash")]
    df = spark.createDataFrame([(base, r, w) for r, w in cases] + [("https://garden.test", "p", "https://garden.test/p")], "b string, r string, want string")
    for row in resolve_urls(df, "b", "r", "got").collect():
        assert row.got == row.want, (row.b, row.r)
