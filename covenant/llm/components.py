"""Connected components of a table of links, by alternating stars: every step is an aggregate and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covenant.session import scratch_path, written


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of bigint nodes to (node, component): the smallest node that can be reached.

    Null nodes and links of a node to itself are left out. Each round writes its links, hangs the larger neighbours of
    every node on its smallest one, then does the same for the smaller neighbours, and stops when no link changes. Chains
    shorten by a constant factor a round. Nodes with many links are met in aggregates that fold before the shuffle.
    """
    spark = links.sparkSession

    def kept(df: DataFrame) -> DataFrame:
        return written(df.where("a <> b").distinct(), scratch_path(spark, "links"))

    now = kept(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a IS NOT NULL AND b IS NOT NULL"))
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        now = kept(_small_star(_large_star(now)))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))
