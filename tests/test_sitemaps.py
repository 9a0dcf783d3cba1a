from webfold.operators.sitemaps import expand_sitemaps, feed_links, sitemap_errors, sitemap_locs, sitemap_seed_urls

NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'


def urlset(*locs):
    return f"<urlset {NS}>" + "".join(f"<url><loc> {u} </loc></url>" for u in locs) + "</urlset>"


def index(*locs):
    return f"<sitemapindex {NS}>" + "".join(f"<sitemap><loc>{u}</loc></sitemap>" for u in locs) + "</sitemapindex>"


def jobs_df(spark, domain="example.com"):
    return spark.createDataFrame([("j", domain)], "job_id string, domain string")


def test_urlset_dedup(spark):
    docs = spark.createDataFrame([("https://example.com/sitemap.xml", 200,
                                   urlset("https://example.com/a", "https://example.com/b", "https://example.com/a"))],
                                 "doc_url string, status int, body string")
    assert sitemap_locs(docs).count() == 3
    seeds = sitemap_seed_urls(jobs_df(spark), docs).orderBy("ord").collect()
    assert [r.loc for r in seeds] == ["https://example.com/a", "https://example.com/b"]


def test_index_child_and_external_child(spark):
    docs = spark.createDataFrame([
        ("https://example.com/sitemap.xml", 200, index("https://cdn.other.com/s.xml", "/child.xml")),
        ("https://cdn.other.com/s.xml", 200, urlset("https://example.com/external")),
        ("https://example.com/child.xml", 200, urlset("https://example.com/post")),
    ], "doc_url string, status int, body string")
    seeds = sitemap_seed_urls(jobs_df(spark), docs).collect()
    assert [r.loc for r in seeds] == ["https://example.com/post"]


def test_fallback_404_and_bad_xml(spark):
    docs = spark.createDataFrame([
        ("https://example.com/sitemap.xml", 404, urlset("https://example.com/x")),
        ("https://example.com/sitemap_index.xml", 200, urlset("https://example.com/y")),
    ], "doc_url string, status int, body string")
    assert [r.loc for r in sitemap_seed_urls(jobs_df(spark), docs).collect()] == ["https://example.com/y"]
    bad = spark.createDataFrame([("https://example.com/sitemap.xml", 200, "this is not xml")],
                                "doc_url string, status int, body string")
    assert sitemap_locs(bad).count() == 0


def test_cyclic_index_ends(spark):
    docs = spark.createDataFrame([
        ("https://example.com/sitemap.xml", 200, index("https://example.com/a.xml")),
        ("https://example.com/a.xml", 200, index("https://example.com/sitemap.xml", "https://example.com/b.xml")),
        ("https://example.com/b.xml", 200, urlset("https://example.com/z")),
    ], "doc_url string, status int, body string")
    roots = spark.createDataFrame([("j", "example.com", 0, "https://example.com/sitemap.xml")],
                                  "job_id string, domain string, prio int, root_url string")
    out = expand_sitemaps(roots, docs).collect()
    assert [r.loc for r in out] == ["https://example.com/z"]


def docs_df(spark, *rows):
    return spark.createDataFrame([(f"https://garden.test/{k}.xml", status, body) for k, (status, body) in enumerate(rows)], "doc_url string, status int, body string")


def test_root_tag_decides_and_errors_are_told(spark):
    docs = docs_df(spark, (200, "<feed><url><loc>https://garden.test/no</loc></url></feed>"), (200, "<?xml version='1.0'?><!-- c -->\n" + urlset("https://garden.test/yes")),
                   (200, "<urlset><url><loc>https://garden.test/cut"), (500, urlset("https://garden.test/x")), (200, ""))
    assert [r.loc for r in sitemap_locs(docs).collect()] == ["https://garden.test/yes"]
    assert {r.doc_url[-5]: r.error for r in sitemap_errors(docs).collect()} == {"0": "no sitemap", "2": "malformed or empty", "3": "http status 500", "4": "no sitemap"}


def test_a_large_sitemap_keeps_all_its_urls(spark):
    locs = [f"https://garden.test/{k}/{'x' * 300}" for k in range(40_000)]
    docs = docs_df(spark, (200, urlset(*locs)))
    assert len(urlset(*locs)) > 10 * 1024 * 1024
    assert sitemap_locs(docs).count() == len(locs)


def test_feeds(spark):
    rss = "<rss><channel><item><link>https://garden.test/a</link></item><item><link> https://garden.test/b </link></item></channel></rss>"
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><link rel="self" href="https://garden.test/s"/><link href="https://garden.test/c"/></entry></feed>'
    got = feed_links(docs_df(spark, (200, rss), (200, atom), (404, rss), (200, urlset("x")))).collect()
    assert sorted((r.doc_url[-5], r.position, r.loc) for r in got) == [("0", 0, "https://garden.test/a"), ("0", 1, "https://garden.test/b"), ("1", 0, "https://garden.test/c")]
