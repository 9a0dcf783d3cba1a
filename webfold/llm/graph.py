"""Connected components of an edge table, by alternating large-star and small-star rounds.

Both rounds are joins and aggregations with map-side combine; the edges of a
round are written to the shared checkpoint folder.  Nothing but a row count and
a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of an edge (a, b): label is the smallest node reachable, itself included."""
    stars = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        stars = cut(large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
    found = stars.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return found.unionByName(found.select(F.col("label").alias("node"), "label").distinct())
