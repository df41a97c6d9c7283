"""Connected components of links between integer ids, by label contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortcast.llm.common import split_join, staged


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)``: the smallest
    node reachable.

    Rounds of two steps until no link changes: every node links its larger
    neighbours, then its smaller ones and itself, to the least of both sorts.
    The links become stars around the smallest nodes in about log rounds; each
    is written to the shared folder.  A hot node's links meet by a partial
    minimum, and are split for the join that carries it back to them.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    last = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = staged(split_join(both.where("v > u"), least, "u", "v").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = split_join(large, low, "u", "v").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                                        F.col("m").alias("v")).where("u <> v").distinct()
        edges = staged(small, "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == last:
            break
        last = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
