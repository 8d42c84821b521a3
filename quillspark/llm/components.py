"""Connected components of links, by smallest member, without gathering them anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import settle


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link, root being the smallest node it reaches.

    ``links`` are rows (a, b) of nodes that order. Each round keeps, for every
    node, the link to its smallest neighbour below it and ties the other
    neighbours below it to that one; links then only point further down, until
    every node has one. Roots follow by doubling the way down. Rounds grow with
    the logarithm of a component's width; each is written to the shared folder.
    Null or equal ends make no link.
    """
    edges = (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("below"))
        .distinct()
    )
    edges = settle(edges)
    while True:
        lowest = edges.groupBy("node").agg(F.min("below").alias("low"), F.count("*").alias("n"))
        if lowest.where("n > 1").isEmpty():
            break
        tied = edges.join(lowest.where("n > 1").select("node", "low"), "node").where("below > low")
        down = lowest.select("node", F.col("low").alias("below"))
        edges = settle(down.union(tied.select(F.col("below").alias("node"), F.col("low").alias("below"))).distinct())
    while True:
        up = edges.select(F.col("node").alias("mid"), F.col("below").alias("root"))
        further = edges.join(up, edges.below == up.mid, "left")
        moved = settle(further.select("node", F.coalesce("root", "below").alias("below"), F.col("root").isNotNull().alias("moved")))
        edges = moved.select("node", "below")
        if moved.where("moved").isEmpty():
            break
    roots = edges.select("node", F.col("below").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
