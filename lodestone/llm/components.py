"""Connected components by DataFrame joins: links and components stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import dropped, written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): root is the smallest node reachable.

    Alternating large-star and small-star steps: each is one grouped minimum and one equi-join, and about log(size)
    rounds suffice whatever the shape of a component. A star's centre has one row per neighbour and the minimum is
    combined before the shuffle, so no neighbourhood is ever gathered. Null ends and self links are ignored.
    """
    edges = written(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links"
    )
    # a step's tasks follow the number of links, not the session's number of partitions
    parts = max(8, edges.count() // 250_000)
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    before = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a < b").distinct()
        large = written(large.coalesce(parts), "star")
        # small star: every node hands its smaller neighbours, and itself, to the smallest of them
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.col("m").alias("x"), F.col("a").alias("y")).union(low.select("m", "b"))
        old, edges = edges, written(small.filter("x < y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct().coalesce(parts), "star")
        dropped(old, large)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(edges.select("a", "a").distinct())
