"""Connected components of a link table, with joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisleframe.llm.shared import stash


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the links (a, b) can reach.

    Every round hangs each root below the smallest root next to it and then shortens all chains of roots, so the number
    of rounds follows the logarithm of the longest path, not its length. Only link and node tables move; nothing comes to the
    driver but the count of links that still join two roots. An empty link table gives no rows; loops do no harm.
    """
    open_ = stash(_both_ways(links).distinct())
    roots = open_.groupBy("a").agg(F.min("a").alias("root")).withColumnRenamed("a", "node")
    roots = stash(roots)
    while open_.filter("a != b").limit(1).count():
        # the smallest neighbour of every root that is smaller than the root itself; larger roots hang below it
        parent = open_.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p"))
        parent = stash(parent)
        while True:
            up = parent.select(F.col("a").alias("p"), F.col("p").alias("q"))
            jumped = stash(parent.join(up, "p").select("a", "p", "q"))
            done = jumped.filter("p != q").limit(1).count() == 0
            parent = jumped.select("a", F.col("q").alias("p"))
            if done:
                break
        top = parent.select(F.col("a").alias("root"), "p")
        roots = stash(roots.join(top, "root", "left").select("node", F.coalesce("p", "root").alias("root")))
        left = parent.select("a", F.col("p").alias("pa"))
        right = parent.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        open_ = stash(open_.join(left, "a").join(right, "b").filter("pa != pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct())
    return roots
