from webfold.operators.frontier import any_host, crawl_frontier, crawl_summary, in_subdomain_scope

LINKS = [("/", 0, "/a"), ("/", 1, "/blog/b"), ("/a", 0, "/"), ("/a", 1, "/c"), ("/blog/b", 0, "/c"), ("/c", 0, "/d"), ("/d", 0, "/a"), ("/d", 1, "//sub.garden.test/e"),
         ("/a", 2, "/tag/x/")]
HOST = "https://garden.test"


def absolute(p):
    return "https:" + p if p.startswith("//") else HOST + p


def tables(spark, captured, max_pages=0, max_depth=0):
    jobs = spark.createDataFrame([("j", "garden.test", ["garden.test", "www.garden.test"], max_pages, max_depth, "links")],
                                 "job_id string, domain string, allowed_domains array<string>, max_pages int, max_depth int, discovery_mode string")
    links = spark.createDataFrame([(absolute(a), k, absolute(b)) for a, k, b in LINKS], "src_url string, position int, dst_url string")
    return jobs, links, spark.createDataFrame([(absolute(c),) for c in captured], "url string")


def paths(df):
    return {(r.url.removeprefix(HOST), r.depth) for r in df.collect()}


ALL = ["/", "/a", "/blog/b", "/c", "/d"]


def test_cycles_and_shared_targets_end(spark):
    assert paths(crawl_frontier(*tables(spark, ALL))) == {("/", 1), ("/a", 2), ("/blog/b", 2), ("/c", 3), ("/d", 4)}


def test_scopes(spark):
    for scope in (in_subdomain_scope, any_host):
        assert ("https://sub.garden.test/e", 5) in paths(crawl_frontier(*tables(spark, ALL), scope=scope))


def test_budget_counts_new_urls_only(spark):
    assert paths(crawl_frontier(*tables(spark, ALL, max_pages=4))) == {("/", 1), ("/a", 2), ("/blog/b", 2), ("/c", 3)}
    assert paths(crawl_frontier(*tables(spark, ALL, max_pages=2))) == {("/", 1), ("/a", 2)}
    assert paths(crawl_frontier(*tables(spark, ALL, max_pages=2), article_first=True)) == {("/", 1), ("/blog/b", 2)}
    assert paths(crawl_frontier(*tables(spark, ALL, max_depth=2))) == {("/", 1), ("/a", 2), ("/blog/b", 2)}


def test_resume_finds_what_was_captured_since(spark):
    earlier = crawl_frontier(*tables(spark, ["/"]))
    assert paths(earlier) == {("/", 1), ("/a", 2), ("/blog/b", 2)}
    assert {u for u, _ in paths(crawl_frontier(*tables(spark, ALL), earlier=earlier))} == set(ALL)


def test_summary_tells_errors_from_links_never_fetched(spark):
    jobs, links, fetched = tables(spark, ["/", "/a"])
    ok = spark.createDataFrame([(HOST + "/a",)], "url string")
    errors = spark.createDataFrame([("j", "fetch"), ("j", "filter")], "job_id string, phase string")
    times = spark.createDataFrame([("j", 10), ("j", 70)], "job_id string, s long").selectExpr("job_id", "timestamp_seconds(s) AS at")
    r = crawl_summary(crawl_frontier(jobs, links, fetched), ok, errors, jobs, times).first()
    assert (r.domain, r.pages_discovered, r.pages_visited, r.pages_extracted, r.pages_not_captured, r.errors, r.duration_seconds) == ("garden.test", 4, 2, 1, 2, 2, 60)


def test_links_stand_relative_to_the_base(spark):
    from webfold.operators.links import page_links
    rows = [(1, "https://garden.test/a/b", "<head><base target=x href='/c/'></head><a href=d>d</a><a href='/e'>e</a>"),
            (2, "https://garden.test/a/b", "<a href=d>d</a>"), (3, "https://garden.test/a", "<base href='https://cdn.test/k/'><a href='l'>l</a>")]
    got = page_links(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.dst_url) for r in got) == [
        (1, "https://garden.test/c/d"), (1, "https://garden.test/e"), (2, "https://garden.test/a/d"), (3, "https://cdn.test/k/l")]


def test_a_job_may_name_its_seed(spark):
    from pyspark.sql import functions as F
    jobs, links, fetched = tables(spark, ALL)
    assert paths(crawl_frontier(jobs.withColumn("seed_url", F.lit("https://garden.test/c")), links, fetched)) == {("/c", 1), ("/d", 2), ("/a", 3), ("/", 4), ("/blog/b", 5)}


def as_rows(df):
    return sorted((r.job_id, r.url, r.depth, list(r.ord), r.captured) for r in df.collect())


def test_a_resumed_run_ends_as_a_fresh_one(spark):
    """Late captures at any level, shorter ways found by them, and depth limits."""
    import random
    rnd = random.Random(6)
    for trial, depth in enumerate((2, 3, 0)):
        nodes = ["/"] + [f"/n{k}" for k in range(14)]
        edges = sorted({(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(26)})
        jobs = tables(spark, ["/"], max_depth=depth)[0]
        links = spark.createDataFrame([(absolute(a), k, absolute(b)) for k, (a, b) in enumerate(edges)], "src_url string, position int, dst_url string")
        captured = lambda some: spark.createDataFrame([(absolute(c),) for c in some], "url string")
        some = ["/"] * (trial != 1) + rnd.sample(nodes[1:], 5)
        earlier = crawl_frontier(jobs, links, captured(some) if some else captured(["/none"]))
        assert as_rows(crawl_frontier(jobs, links, captured(nodes), earlier=earlier)) == as_rows(crawl_frontier(jobs, links, captured(nodes)))


def test_resume_at_the_depth_limit(spark):
    earlier = crawl_frontier(*tables(spark, ["/x"], max_depth=2))
    assert paths(earlier) == {("/", 1)}
    assert paths(crawl_frontier(*tables(spark, ALL, max_depth=2), earlier=earlier)) == {("/", 1), ("/a", 2), ("/blog/b", 2)}


def test_resume_counts_what_is_scheduled(spark):
    earlier = crawl_frontier(*tables(spark, ["/"], max_pages=4))
    assert len(paths(earlier)) == 3
    assert paths(crawl_frontier(*tables(spark, ALL, max_pages=4), earlier=earlier)) == {("/", 1), ("/a", 2), ("/blog/b", 2), ("/c", 3)}


def test_a_budget_of_a_hot_job_is_spread(spark):
    from pyspark.sql import functions as F

    from webfold.operators.frontier import _within_budget
    n, budget = 6000, 2000
    hot = spark.range(n).select(F.lit("hot").alias("job_id"), F.concat(F.lit("u"), F.col("id")).alias("url"), F.array((F.col("id") * 7919) % n).alias("okey"))
    small = spark.createDataFrame([("few", "a", [1]), ("few", "b", [0]), ("none", "a", [0]), ("free", "z", [5])], "job_id string, url string, okey array<long>")
    limits = spark.createDataFrame([("hot", budget), ("few", 2), ("none", 0), ("free", -1)], "job_id string, remaining long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges would be joined again
    try:
        got = _within_budget(hot.unionByName(small), limits)
        dealt = [r["count"] for r in hot.repartitionByRange("job_id", "okey", "url").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(dealt) == 4 and max(dealt) < n / 2  # a share each
    rows = [(r.job_id, r.url) for r in got.collect()]
    assert sorted(x for x in rows if x[0] != "hot") == [("few", "a"), ("few", "b"), ("free", "z")]
    want = {r.url for r in hot.orderBy("okey", "url").limit(budget).collect()}
    assert len(rows) == len(set(rows)) == budget + 3 and {u for j, u in rows if j == "hot"} == want
