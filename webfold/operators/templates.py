"""A8 on the elements: page templates as subtrees that repeat on the pages of a host, whatever their text.

Each element has a Merkle hash of its tag, id, classes and children's hashes.
Text does not count, digits in names count as 0, and equal neighbours count once, so a menu is one
structure however many items it has.  An element that is main content, lies in it or
holds it (``article``, ``main``) is never a template.  A subtree is reported if its structure
stands on enough of a host's pages without being part of a larger one that does.

One narrow pass makes (host, node, parent) rows; counts are aggregations with
map-side combine, and the one join is on (host, parent) after the rows of a
node were summed, so neither a hot host nor a structure on all its pages is a hot key.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webfold.functions.dom import Page
from webfold.functions.urls import parse_urls, url_part_columns

MAIN = ("article", "main")
NEVER = ("#page", "html", "head", "body", *MAIN)


def structures(html: str | None) -> dict[tuple[bytes, bytes], tuple[str, int]]:
    """{(node, parent): (tag, elements)} of a page's elements outside its main content; hashes of 16 bytes."""
    page = Page(html)
    within, until = set(), -1
    for e in page.elements:
        if e.first > until and e.tag in MAIN:
            until = e.last
        if e.first <= until:
            within.add(e)
            while (e := e.parent) is not None and e not in within:
                within.add(e)
    kinds: dict = {}
    waiting: dict = {}  # children that are done, of elements that are open
    out: dict[tuple[bytes, bytes], tuple[str, int]] = {}
    order = sorted(page.elements, key=lambda e: e.last)  # children before parents
    for e in order:
        parts, size, before = [], 1, None
        for child in sorted(waiting.pop(e, ()), key=lambda c: c.first):
            digest, n = kinds[child]
            if digest != before:
                parts.append(digest)
                size += n
            before = digest
        names = re.sub(r"[0-9]+", "0", f"{e.attribute('id')}|{' '.join(sorted(e.attribute('class').split()))}") if e.source else "|"
        kinds[e] = hashlib.blake2b(f"{e.tag}|{names}|".encode("utf-8", "replace") + b"".join(parts), digest_size=16).digest(), size
        waiting.setdefault(e.parent, []).append(e)
    for e in page.elements:
        if e.tag not in NEVER and e not in within:
            parent = b"" if e.parent in within or e.parent.tag in NEVER else kinds[e.parent][0]
            out[kinds[e][0], parent] = e.tag, kinds[e][1]
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, nodes, parents, tags, sizes = [], [], [], [], []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = structures(html)
            per_node = {}
            for (node, parent), (tag, size) in found.items():
                hosts.append(host), nodes.append(node), parents.append(parent), tags.append(tag), sizes.append(size)
                per_node[node] = tag, size
            for node, (tag, size) in [(None, (None, 0)), *per_node.items()]:  # one row a page and node, and one a page
                hosts.append(host), nodes.append(node), parents.append(None), tags.append(tag), sizes.append(size)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(nodes, pa.binary()), pa.array(parents, pa.binary()),
                                          pa.array(tags, pa.string()), pa.array(sizes, pa.int32())], names=["host", "node", "parent", "tag", "n_elements"])


def template_subtrees(pages: DataFrame, min_share_pct: int = 50, min_pages: int = 2, min_elements: int = 3) -> DataFrame:
    """(host, node, tag, n_elements, n_pages, host_pages): the largest structures of at least ``min_elements`` elements
    on at least ``min_share_pct`` % (and ``min_pages``) of a host's pages."""
    hosts = parse_urls(pages.select("url", "html"), "url", "_b").withColumn("host", F.col("_b_host")).drop(*url_part_columns("_b"))
    rows = (hosts.filter("host IS NOT NULL").select("host", "html").mapInArrow(_rows, "host string, node binary, parent binary, tag string, n_elements int")
            .groupBy("host", "node", "parent", "tag", "n_elements").agg(F.count("*").alias("n")).checkpoint())
    per_host = rows.filter("node IS NULL").groupBy("host").agg(F.sum("n").alias("host_pages"))

    def enough(n: str):
        return (F.col(n) >= min_pages) & (F.col(n) * 100 >= F.col("host_pages") * min_share_pct)

    per_node = rows.filter("node IS NOT NULL AND parent IS NULL").select("host", "node", "tag", "n_elements", F.col("n").alias("n_pages"))
    found = per_node.filter(F.col("n_elements") >= min_elements).join(per_host, "host").filter(enough("n_pages")).checkpoint()
    parents = found.select("host", F.col("node").alias("parent"))
    outer = (rows.filter("parent IS NOT NULL").join(parents, ["host", "parent"], "left_anti")
             .groupBy("host", "node").agg(F.sum("n").alias("n_outer")))
    return found.join(outer, ["host", "node"]).filter(enough("n_outer")).select("host", F.lower(F.hex("node")).alias("node"), "tag", "n_elements", "n_pages", "host_pages")
