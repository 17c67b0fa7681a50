"""Connected components of an edge table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellframe.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of ``edges`` (a, b).

    Alternates two steps until nothing changes: each node hands its larger neighbours to its least
    neighbour, then itself and its smaller neighbours. Chains halve, so rounds grow with the logarithm of
    the longest one. The links stay a distributed table of at most one row per link throughout.
    """
    links = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    before = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        links = stage(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    found = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.union(found.select(F.col("component").alias("node"), "component").distinct())
