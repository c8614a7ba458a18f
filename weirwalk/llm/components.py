"""Connected components of links between numbers, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirwalk.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(a, b) pairs, in any order, repeated or not → (node, component) for every number in them; the component is the smallest member.

    Large-star and small-star steps by turns: every node hands its smallest neighbour on, first to its larger and then to its smaller
    neighbours, until all hang on their smallest. A step is an aggregation that combines on the map side and a join with one row per node, so a
    node with very many links is no burden. Each round is written to the shared folder, which cuts the lineage.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u")
        handed = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(handed.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
