"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.sources.shared import staged


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _least(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of every node, itself included; hot nodes are summed up before the shuffle."""
    return edges.groupBy("u").agg(F.least("u", F.min("v")).alias("least"))


def components(links: DataFrame) -> DataFrame:
    """node, component of every node in ``links`` (u, v: long): the smallest node it can reach.

    Large-star and small-star steps in turn hang each node's neighbours below
    the smallest of them until nothing but stars is left, which takes few rounds
    whatever the components' shape.  Each round is written, so no lineage grows.
    Links that are NULL on a side, or from a node to itself, are left out.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = staged(edges.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct(), "links")
    while True:
        around = _both(edges)
        large = around.join(_least(around), "u").filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.select(F.col("u"), F.col("v"))
        below = _least(down)
        small = down.join(below, "u").filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        hung = small.union(below.filter("u <> least").select("u", F.col("least").alias("v")))
        # A round that changes nothing leaves stars: each node once, its root nowhere on the left.
        now = staged(hung.filter("u <> v").distinct(), "stars")
        if now.groupBy("u").count().filter("count > 1").isEmpty() and now.join(now.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break
        edges = now
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
