"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import stage


def components(spark: SparkSession, edges: DataFrame, limit: int = 100) -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` (a, b); the root is the
    smallest node of the component.

    Each round hangs a node's larger neighbours, then its smaller ones, on its
    smallest neighbour; a component ends as a star after about log(size) rounds.
    Every round is one written table, so a lost executor costs one round.
    Minima are aggregated before the shuffle and written before they are joined:
    Spark can split a hub's rows in a join of two tables, not beside an aggregate.
    """
    now = stage(spark, edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    for _ in range(limit):
        if _stars(now):
            break
        both = now.union(now.select("v", "u"))
        least = stage(spark, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-least")
        # large star: larger neighbours go to the smallest neighbour or the node itself
        large = stage(spark, both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .where("u <> v").distinct(), "cc")
        # small star: a node and its smaller neighbours go to the smallest of them
        least = stage(spark, large.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
        now = stage(spark, large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .union(least.select("u", "m")).where("u <> v").distinct(), "cc")
    else:
        raise RuntimeError(f"components need more than {limit} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Every node hangs on one other at most, and none that hangs is hung upon."""
    down = edges.groupBy("u").agg(F.count("*").alias("n"))
    return down.where("n > 1").isEmpty() and edges.join(down.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()
