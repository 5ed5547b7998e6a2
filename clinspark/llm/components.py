"""Connected components of a distributed link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinspark.llm.store import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that has a link; the component is its smallest node.

    Alternating large-star and small-star steps: each round joins every node with the smallest of its
    neighbours until the links form stars.  Minima are combined before the shuffle, every round is written to
    the shared folder, and only a row count and a checksum reach the driver."""
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links"
    )
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return roots.unionByName(edges.select(F.col("u").alias("node"), F.col("v").alias("component")))
