"""Time the headline queries; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, optional).  Each query runs to completion through
the ``noop`` sink (full execution, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "article_manifest",   # flagship: extract → validate → hash → path → manifest
    "crawled_pages",      # + Markdown and front matter
    "page_links",         # link graph
    "link_graph",         # per-host link summary (aggregation)
    "crawl_frontier",     # sitemaps + bounded BFS over all jobs
    "template_blocks",    # boilerplate detection (grouping on host, block)
    "content_dedup",      # documents: content-hash dedup
    "word_count",         # documents: Unicode word count
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    from webfold.plans.catalog import QUERIES
    from webfold.session import get_spark
    spark = get_spark(f"local[{cpus}]", app="webfold-bench", shuffle_partitions=max(2 * cpus, 8))
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None}))
    spark.stop()


if __name__ == "__main__":
    main()
