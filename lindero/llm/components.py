"""Connected components of a table of links, without bringing links to the driver.

Alternating stars: every node's larger neighbours are tied to the smallest node it knows, then every node's smaller
ones, until nothing changes. Each minimum is aggregated before the shuffle and written, a row a node; links then join it
as a shuffle of their own, which AQE cuts where a node has very many links (nothing else needs that partitioning, so it
may). Each step's result is a written table, so a lost executor costs one step; tables that are done with are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, remove


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> (node, root) for every node with a link to another; root is the component's smallest node."""
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        # large star: larger neighbours of a node go to the least of the node and its neighbours
        two = both(edges)
        least = materialize(two.groupBy("a").agg(F.least("a", F.min("b")).alias("m")))
        large = materialize(two.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        remove(least)
        remove(edges)
        # small star: smaller neighbours, and the node itself, go to the least smaller neighbour
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")))
        joined = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = materialize(joined.union(least.select("a", F.col("m").alias("b"))).distinct())
        # done when every node has one link and no target has one of its own
        deep = small.select(F.col("b").alias("a")).distinct().join(small, "a", "left_semi").limit(1).count()
        many = small.groupBy("a").count().where("count > 1").limit(1).count()
        remove(least)
        remove(large)
        edges = small
        if not deep and not many:
            break
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("node", F.col("node").alias("root")))
