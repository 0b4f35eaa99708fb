"""Connected components over an edge table by alternating large-star and small-star steps.

Edges stay in Spark; each step is an aggregate with map-side combine and a join that Spark can split at a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import cut


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, label), label being the least node reachable, for each node that has an edge to another node."""
    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(), "edges")
    mark = _mark(e)
    while mark[0]:
        # Large star: each larger neighbour of a node is tied to the least of the node and its neighbours.
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = e.select(F.col("v").alias("c"), F.col("u").alias("w")).join(least, "c").select(F.col("w").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        # Small star: a node and its smaller neighbours are tied to the least of them.
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(m, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u > v").distinct()
        small = cut(small, "stars")
        now = _mark(small)
        e = small
        if now == mark:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(e.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
