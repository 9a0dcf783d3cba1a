"""The bounded crawl frontier for many jobs.

One driver loop iteration per depth level, each a handful of DataFrame
joins (never a per-URL loop):

    cand  = frontier(level k, fetched pages only) ⋈ links      (J3, S6)
    cand  = cand ∩ allowed(job)                                  (F3, J1)
    cand  = groupBy(job, url).min(ord ++ [position])             (A3, partial agg)
    cand  = cand ▷ scheduled                                     (J2, left_anti)
    new   = first ``remaining`` per job in ord order             (W1, W2)
    scheduled ∪= checkpoint(new)                                 (O4)

Ordering (W4): level 1 is the sitemap URLs in document order, then the
homepage; a URL found at level k+1 gets ``ord = parent ord ++ [link
position]`` (lexicographic order = parent order, then position).  The budget counts scheduled URLs (discovered); a URL
refused by depth or scope never takes a slot (W2), so refusals are filters
applied before ranking.

Skew: a job may own a third of all URLs, or all of them.  A budget is applied
by ranges of the order key, spread over all tasks, of which only the one a
job's budget ends in is ranked; jobs with room for all candidates skip this.  Dedup is a
partial aggregate; the anti-join is keyed by ``(job_id, url)``, which spreads a
hot job over all partitions.

Lineage: every level is written with ``checkpoint()`` to the shared folder
named by ``spark.checkpoint.dir`` (reliable, so a lost executor recomputes
from the last level, not from the start).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webfold.constants import DISCOVERY_MODES
from webfold.functions.urls import normalize_urls, parse_urls, url_part_columns, is_article_path, is_blacklisted_path


def validate_jobs(jobs: DataFrame) -> DataFrame:
    """``reject_reason`` is null for a valid job (max_pages ≥ 0,
    max_depth ≥ 0, mode ∈ {sitemap, links, both} after lowercasing)."""
    mode = F.lower(F.trim(F.col("discovery_mode")))
    reason = (F.when(F.col("max_pages").isNull() | (F.col("max_pages") < 0), F.lit("max_pages must be >= 0"))
              .when(F.col("max_depth").isNull() | (F.col("max_depth") < 0), F.lit("max_depth must be >= 0"))
              .when(~F.coalesce(mode.isin(*DISCOVERY_MODES), F.lit(False)),
                    F.concat(F.lit("invalid discovery mode: "), F.coalesce(F.col("discovery_mode"), F.lit(""))))
              .when(F.coalesce(F.col("domain"), F.lit("")) == "", F.lit("domain is required")))
    return jobs.withColumns({"discovery_mode": mode, "reject_reason": reason})


def job_hosts(jobs: DataFrame) -> DataFrame:
    """(job_id, host) for every allowed host of every job."""
    return jobs.select("job_id", F.explode("allowed_domains").alias("host")).select(
        "job_id", F.lower("host").alias("host")).distinct()


def url_checks(df: DataFrame, url: str) -> DataFrame:
    """Add ``host`` of column ``url`` and drop rows that do not parse or whose
    path is blacklisted (F2): done once per URL, before any join."""
    df = parse_urls(df, url, "_a")
    df = df.filter(F.col("_a_ok") & ~is_blacklisted_path(F.col("_a_path")))
    return df.withColumn("host", F.col("_a_host")).drop(*url_part_columns("_a"))


def in_job_scope(cand: DataFrame, jobs: DataFrame) -> DataFrame:
    """The candidate's host is one of the job's allowed hosts (equi
    semi-join on (job_id, host); hosts per job are few)."""
    return cand.join(job_hosts(jobs), ["job_id", "host"], "left_semi")


def in_subdomain_scope(cand: DataFrame, jobs: DataFrame) -> DataFrame:
    """the host is an allowed one or below one: the host's suffixes at its
    dots are exploded and equi-joined."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    match = (cand.select("job_id", "host").distinct().withColumn("below", F.explode(suffixes))
             .join(job_hosts(jobs).select("job_id", F.col("host").alias("below")), ["job_id", "below"], "left_semi")
             .select("job_id", "host").distinct())
    return cand.join(match, ["job_id", "host"], "left_semi")


def any_host(cand: DataFrame, jobs: DataFrame) -> DataFrame:
    """No host scope."""
    return cand


def allowed_candidates(cand: DataFrame, jobs: DataFrame, url: str = "url", scope=in_job_scope) -> DataFrame:
    """F3 per job: host in scope and path not blacklisted."""
    return scope(url_checks(cand, url), jobs).drop("host")


def seeds(jobs: DataFrame, sitemap_urls: DataFrame | None, scope=in_job_scope) -> DataFrame:
    """Level-1 candidates (job_id, url, okey).

    Sitemap URLs (mode sitemap|both) are normalised and must pass F3; the
    homepage ``https://<domain>/`` (mode links|both) skips F3.  ``okey`` is
    ``[0] ++ ord`` for a sitemap entry (document order) and ``[1]`` for the
    homepage, so sitemap entries come first.
    """
    front = F.concat(F.lit("https://"), F.col("domain"), F.lit("/"))
    if "seed_url" in jobs.columns:  # U5: a job may name its own first page
        front = F.coalesce(F.nullif(F.trim("seed_url"), F.lit("")), front)
    home = jobs.filter(F.col("discovery_mode").isin("links", "both")).select("job_id", front.alias("raw"))
    home = normalize_urls(home, "raw", "url").filter(F.col("url").isNotNull()).select(
        "job_id", "url", F.array(F.lit(1).cast("long")).alias("okey"))
    if sitemap_urls is None:
        return home
    sm_jobs = jobs.filter(F.col("discovery_mode").isin("sitemap", "both")).select("job_id")
    sm = sitemap_urls.join(sm_jobs, "job_id", "left_semi")
    sm = normalize_urls(sm, "loc", "url").filter(F.col("url").isNotNull())
    sm = allowed_candidates(sm.select("job_id", "url", "ord"), jobs, scope=scope)
    sm = sm.select("job_id", "url", F.concat(F.array(F.lit(0).cast("long")), F.col("ord").cast("array<long>")).alias("okey"))
    return sm.unionByName(home)


def _within_budget(cand: DataFrame, budget: DataFrame) -> DataFrame:
    """Keep at most ``remaining`` rows per job in (``okey``, ``url``) order.

    ``budget``: (job_id, remaining), remaining < 0 meaning unlimited.  Jobs that
    are unlimited, or have no more candidates than slots, keep all their rows
    and sort nothing.  The others' rows are dealt into ranges of (job, okey,
    url) and written once, so a job with all the URLs is spread over all tasks;
    a count per range and job tells which ranges lie wholly within the
    budget, and only the one range a job's budget ends in is ranked.
    """
    counts = cand.groupBy("job_id").agg(F.count("*").alias("_n"))
    over = (counts.join(budget, "job_id").filter((F.col("remaining") >= 0) & (F.col("_n") > F.col("remaining")))
            .select("job_id", "remaining").checkpoint())
    if over.isEmpty():
        return cand
    kept = cand.join(over.select("job_id"), "job_id", "left_anti")
    ranges = cand.join(over.filter(F.col("remaining") > 0), "job_id").repartitionByRange("job_id", "okey", "url")
    ranges = ranges.withColumn("_range", F.spark_partition_id()).checkpoint()
    sizes = ranges.groupBy("job_id", "_range", "remaining").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("job_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    # a row per job and range: at most jobs + ranges rows
    sizes = sizes.withColumn("_left", F.col("remaining") - F.coalesce(before, F.lit(0))).filter(F.col("_left") > 0).select("job_id", "_range", "_left", "_n")
    taken = ranges.drop("remaining").join(sizes, ["job_id", "_range"])
    rank = F.row_number().over(Window.partitionBy("job_id", "_range").orderBy("okey", "url"))
    edge = taken.filter(F.col("_n") > F.col("_left")).withColumn("_rn", rank).filter(F.col("_rn") <= F.col("_left"))
    return (kept.unionByName(taken.filter(F.col("_n") <= F.col("_left")).select(*cand.columns))
            .unionByName(edge.select(*cand.columns)))


def crawl_frontier(jobs: DataFrame, links: DataFrame, fetched: DataFrame,
                   sitemap_urls: DataFrame | None = None, checkpoint: bool = True, scope=in_job_scope,
                   earlier: DataFrame | None = None, article_first: bool = False) -> DataFrame:
    """Every scheduled URL per job: (job_id, url, depth, ord, captured).

    ``jobs``: validated jobs (job_id, domain, allowed_domains, max_pages,
    max_depth, discovery_mode); 0 means unlimited for both limits.
    ``links``: (src_url, position, dst_url), normalised.  ``fetched``: (url)
    of captured HTML pages, normalised.  ``ord`` is the discovery order key:
    the positions on the path from the seed (lexicographic order).  ``scope``
    (X5) filters candidates (job_id, url, host, ...) given the jobs.  ``earlier``
    (O5) is the result of an earlier run to resume: its URLs stay scheduled and
    take budget.  Pages captured since are expanded at their own level, shorter
    ways lower what lies behind them, and new seeds join, so a resumed run ends as a
    fresh one would (where no budget binds).  ``article_first`` (F19, W6) ranks URLs that look like
    articles before the others found at the same level.
    """
    jobs = jobs.select("job_id", "domain", "allowed_domains", "max_pages", "max_depth", "discovery_mode",
                       *[c for c in ("seed_url",) if c in jobs.columns])
    spark = jobs.sparkSession
    stats = jobs.agg(F.max(F.when(F.col("max_depth") > 0, F.col("max_depth"))).alias("depth"),
                     F.max((F.col("max_depth") == 0).cast("int")).alias("unl")).first()
    finite_max_depth, any_unlimited_depth = stats["depth"] or 0, bool(stats["unl"])
    fetched = fetched.select("url").distinct()
    limits = jobs.select("job_id", "max_pages", "max_depth")
    # host and blacklist of each target once, before the loop
    edges = url_checks(links.select("src_url", "position", "dst_url"), "dst_url")
    if article_first:
        edges = parse_urls(edges, "dst_url", "_e").withColumn("rank", (~is_article_path(F.col("_e_path"))).cast("long")).drop(*url_part_columns("_e"))
    else:
        edges = edges.withColumn("rank", F.lit(0).cast("long"))
    if checkpoint:
        # every level reads these: write them once, keep the loop's plans small
        jobs, fetched, edges = jobs.checkpoint(), fetched.checkpoint(), edges.checkpoint()
        limits = jobs.select("job_id", "max_pages", "max_depth")

    def budget_after(scheduled: DataFrame | None) -> DataFrame:
        used = (scheduled.groupBy("job_id").agg(F.count("*").alias("used")) if scheduled is not None
                else spark.createDataFrame([], "job_id string, used long"))
        return limits.join(used, "job_id", "left").select(
            "job_id",
            F.when(F.col("max_pages") <= 0, F.lit(-1).cast("long"))
            .otherwise(F.greatest(F.col("max_pages") - F.coalesce(F.col("used"), F.lit(0)), F.lit(0)).cast("long"))
            .alias("remaining"))

    def dedup(c: DataFrame) -> DataFrame:
        return c.groupBy("job_id", "url").agg(F.min("okey").alias("okey"))

    def written(df: DataFrame) -> DataFrame:
        return df.checkpoint() if checkpoint else df

    def expand(level: DataFrame) -> DataFrame:
        """What fetched pages link to, for jobs whose depth limit allows another level: (job_id, url, okey)."""
        parents = (level.join(fetched, "url", "left_semi").join(limits, "job_id")
                   .filter((F.col("max_depth") == 0) | (F.col("depth") < F.col("max_depth")))
                   .select("job_id", F.col("url").alias("src_url"), "okey"))
        step = F.array(F.col("rank"), F.col("position").cast("long")) if article_first else F.array(F.col("position").cast("long"))
        cand = parents.join(edges, "src_url").select("job_id", F.col("dst_url").alias("url"), "host", F.concat("okey", step).alias("okey"))
        return dedup(scope(cand, jobs))

    if earlier is None:
        level = written(_within_budget(dedup(seeds(jobs, sitemap_urls, scope)), budget_after(None)).withColumn("depth", F.lit(1)))
        scheduled, depth = level, 1
        while any_unlimited_depth or depth < finite_max_depth:
            cand = written(expand(level).join(scheduled.select("job_id", "url"), ["job_id", "url"], "left_anti"))
            depth += 1
            level = written(_within_budget(cand, budget_after(scheduled)).withColumn("depth", F.lit(depth)))
            if level.isEmpty():
                break
            scheduled = scheduled.unionByName(level)  # a union of written levels: nothing is written twice
    else:
        was = F.coalesce(F.col("captured"), F.lit(False)) if "captured" in earlier.columns else F.lit(False)
        known = earlier.select("job_id", "url", F.col("ord").alias("okey"), F.col("depth").cast("int").alias("depth"), was.alias("was")).checkpoint()
        late = known.filter(~F.col("was")).join(fetched, "url", "left_semi").select("job_id", "url", "okey", "depth").checkpoint()
        late_at = sorted(r.depth for r in late.select("depth").distinct().collect())  # a number per level
        scheduled, count = known.drop("was"), known.select("job_id", "url")

        def better(cand: DataFrame, depth: int) -> DataFrame:
            """Candidates that are new (within the budget), or come before what is known of their URL."""
            best = scheduled.groupBy("job_id", "url").agg(F.min(F.struct("depth", "okey")).alias("_known"))
            cand = written(cand.withColumn("depth", F.lit(depth)).join(best, ["job_id", "url"], "left"))
            new = _within_budget(cand.filter(F.col("_known").isNull()).drop("_known"), budget_after(count))
            return written(new.unionByName(cand.filter(F.struct("depth", "okey") < F.col("_known")).drop("_known")))

        depth, level = 1, better(dedup(seeds(jobs, sitemap_urls, scope)), 1)
        while True:
            if level.isEmpty():  # go on at the next level with a page captured since
                depth = next((d for d in late_at if d >= depth), None)
                if depth is None:
                    break
            else:
                count = count.unionByName(level.select("job_id", "url").join(count, ["job_id", "url"], "left_anti"))
                scheduled = scheduled.unionByName(level)
            if not any_unlimited_depth and depth >= finite_max_depth:
                break
            level = better(expand(level.unionByName(late.filter(F.col("depth") == depth))), depth + 1)
            depth += 1
        first = scheduled.groupBy("job_id", "url").agg(F.min(F.struct("depth", "okey")).alias("_r"))
        scheduled = first.select("job_id", "url", "_r.okey", "_r.depth")
    captured = fetched.select("url", F.lit(True).alias("captured"))
    return scheduled.join(captured, "url", "left").select(
        "job_id", "url", F.col("depth").cast("int").alias("depth"), F.col("okey").alias("ord"),
        F.coalesce("captured", F.lit(False)).alias("captured"))


def crawl_summary(frontier: DataFrame, extracted_ok: DataFrame, errors: DataFrame | None = None, jobs: DataFrame | None = None,
                  times: DataFrame | None = None) -> DataFrame:
    """Per job — discovered (scheduled), visited (captured HTML),
    extracted (passed F6 and saved), not captured (scheduled without a page),
    and errors (rows of ``errors`` (job_id, phase): failures are not the same as
    links never fetched).  With ``jobs`` the domain, with ``times`` (job_id, at)
    U16's started, finished and duration in seconds."""
    ok = extracted_ok.select("url").distinct().withColumn("_ok", F.lit(1))
    f = frontier.join(ok, "url", "left")
    agg = f.groupBy("job_id").agg(
        F.count("*").alias("pages_discovered"),
        F.count_if(F.col("captured")).alias("pages_visited"),
        F.count_if(F.col("_ok").isNotNull()).alias("pages_extracted"),
        F.count_if(~F.col("captured")).alias("pages_not_captured"),
        F.max("depth").cast("int").alias("max_depth_reached"),
    )
    if errors is not None:
        agg = agg.join(errors.groupBy("job_id").agg(F.count("*").alias("errors")), "job_id", "left")
    else:
        agg = agg.withColumn("errors", F.lit(None).cast("long"))
    agg = agg.withColumn("errors", F.coalesce("errors", F.lit(0)).cast("long"))
    if jobs is not None:
        agg = agg.join(jobs.select("job_id", "domain"), "job_id", "left")
    if times is not None:
        span = times.groupBy("job_id").agg(F.min("at").alias("started_at"), F.max("at").alias("finished_at"))
        agg = agg.join(span, "job_id", "left").withColumn("duration_seconds", F.unix_timestamp("finished_at") - F.unix_timestamp("started_at"))
    return agg
