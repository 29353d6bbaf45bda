"""Connected components of a link table by alternating star contraction, all in DataFrame joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(links: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """(node, root): root is the smallest node that links reach from node. Nodes without links don't appear.

    Each round points every node's larger neighbours at its smallest neighbour, then its smaller ones;
    rounds end when the edges are stars, after about log(diameter) of them. Edges never grow in number, no
    neighbourhood is collected, and only a count and a checksum of the edges reach the driver. Null nodes and
    self-links are left out.
    """
    edges = materialize(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "links")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "large")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = materialize(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
            return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = now
