"""Connected components by alternating large-star and small-star steps.

A step is one aggregation (combined on the map side, so a hub with a third of all
links costs little) and one join with it, whose skewed keys AQE can split. Each round
is written to the shared folder, which cuts the lineage. Only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.llm.base import stage


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both(edges)
    least = near.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
    joined = near.where("dst > src").join(least, "src")
    return joined.select(F.col("dst").alias("src"), F.col("m").alias("dst"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = down.groupBy("src").agg(F.min("dst").alias("m"))
    moved = down.join(least, "src").where("dst <> m").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    return moved.union(least.select("src", F.col("m").alias("dst")))


def components(edges: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """(node, root) for every node with a link to another; root is the least node it reaches."""
    links = edges.select(F.col(a).alias("src"), F.col(b).alias("dst")).where("src <> dst")
    now = stage(_small_star(links.distinct()).distinct())
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(20,0)"))).first()
        if seen == mark:
            break
        mark = seen
        now = stage(_small_star(_large_star(now).distinct()).distinct())
    node = now.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("root"))
    roots = now.select(F.col("dst").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return node.union(roots.join(node, "node", "left_anti"))
