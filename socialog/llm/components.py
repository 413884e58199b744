"""Connected components of a link table, without a driver or one-task step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from socialog.session import written


def _linked_to_least(links: DataFrame) -> DataFrame:
    """Large star: the larger neighbours of each node go to the least of its neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _smaller_to_least(links: DataFrame) -> DataFrame:
    """Small star: the smaller neighbours of each node, and the node, go to their least."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.withColumnRenamed("least", "b")).filter("a <> b")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b); the root is the least node reachable.

    Large and small stars alternate until nothing changes. A node's neighbours are
    never gathered: each step is a minimum per node, combined before the shuffle,
    joined back to the links, which adaptive execution may split. Each round is
    written, so a lost executor costs one round at most.
    """
    kept = written(links.filter("a <> b").select("a", "b").distinct(), "links")
    mark = None
    while True:
        now = tuple(
            kept.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        )
        if now == mark or not now[0]:
            return kept.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                kept.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        mark = now
        stars = written(_linked_to_least(kept).distinct(), "links")
        kept = written(_smaller_to_least(stars).distinct(), "links")
