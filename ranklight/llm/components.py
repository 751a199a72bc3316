"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranklight.session import settle


def _large_star(links: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to its smallest one."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.filter("a > b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).filter("a > b").distinct()


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) of every linked node that is not the root.

    ``links`` has columns a and b, longs, in any order; null ends and loops are left out. Each round
    turns the links toward the smallest node reachable and is written to the shared
    folder. A hub's links meet its minimum in a join whose large partitions are split.
    """
    now = settle(
        links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    mark = None
    for _ in range(most_rounds):
        now = settle(_small_star(_large_star(now)), "links")
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b"))).first()
        if seen == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = seen
    raise RuntimeError("the components did not settle")
