"""Connected components by alternating stars.

Large stars hang every larger neighbour of a node on the node's smallest neighbour, small stars do the
same below it; once nothing changes, every node hangs on the smallest node of its component. Each round
is stored in the shared folder, so lost executors cost one round at most and plans stay short. A hub is
only ever grouped by a minimum (combined before the shuffle) and joined (split when skewed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.plans.scratch import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """`edges` have a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), a < b; root is the component's smallest node."""
    def state(df: DataFrame) -> tuple:
        mark = F.xxhash64("a", "b")
        return tuple(df.agg(F.count("*"), F.sum(mark.cast("decimal(38,0)")), F.bit_xor(mark)).first())

    edges = staged(edges.select("a", "b"), "links")
    before = None
    while (now := state(edges)) != before:
        before = now
        edges = staged(_small_star(_large_star(edges)), "stars")
    roots = edges.select(F.col("a").alias("node")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
