"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmill.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node reachable, for every node of the links (a, b).

    Stars in turns: every node hangs its larger neighbours, then all its neighbours, under the
    smallest node that it knows; the stars grow to whole components in a number of rounds of the
    order of the logarithm of the nodes. Each round is stored, so that a lost executor costs
    tasks, not rounds. A node with many links is a few partial minima before the shuffle, and one
    join key of a skewed join.
    """
    edges = stored(links.select("a", "b").where("a <> b").distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        # Large star: neighbours larger than the node go to the least.
        large = (
            both.join(least, F.col("a") == F.col("n"))
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        # Small star: the node and its smaller neighbours go to the least of them.
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        root = root.select(F.col("a").alias("n"), "m")
        small = (
            large.join(root, F.col("a") == F.col("n"))
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        new = stored(small, "links")
        same = new.count() == edges.count() and new.exceptAll(edges).isEmpty()
        edges = new
        if same:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
