"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node reached) of every node with a link; links are (a, b), of type long.

    Each round connects the neighbours of every node to the smallest of them; rounds end when nothing changes, which
    takes a number that grows with the logarithm of the longest chain. Links stay in the shared folder.
    """
    edges = saved(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(_ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("u"), F.col("m")), F.struct(F.col("v").alias("u"), F.col("m")))).alias("e"))
            .select(F.col("e.u").alias("u"), F.col("e.m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        edges = saved(small)
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
    raise RuntimeError(f"components did not settle in {_ROUNDS} rounds")
