"""Connected components of an edge table, by alternating large-star and small-star rounds.

Every round is joins and aggregations on tables no larger than the edges; the
driver only sees a count and a checksum. Each round is written to the shared
folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import written


def _star(pairs: DataFrame) -> DataFrame:
    """(u, v) with v's least neighbour, u's own value included, as m."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return pairs.join(least, "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) that is not itself its component's least node.

    Self-loops, repeated edges and edges with a null end are ignored; no edges give no rows.
    """
    e = written(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _star(large)
        e = written(small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "star")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
