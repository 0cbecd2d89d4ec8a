"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latticeframe.llm.common import cut


def _stars(now: DataFrame) -> bool:
    """Whether every id points at one other, which points nowhere."""
    if now.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count():
        return False
    heads = now.select(F.col("v").alias("u")).distinct()
    return now.join(heads, "u", "left_semi").limit(1).count() == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """`id, root` for every id in `edges` (columns a, b): `root` is the smallest id of its component.

    Alternates large-star and small-star steps, each a grouped minimum and a join, until only stars are left; the
    number of rounds grows with the logarithm of the longest path. Repeated edges don't matter, and an edge from an
    id to itself makes it known. Grouped minima are cut off before they are joined: Spark can split a skewed join
    only if neither side is an aggregate on its key. Edges and ids never come to the driver.
    """
    # Written with the edges from an id to itself, so that whatever makes the edges runs once
    given = edges.filter("a is not null and b is not null")
    pairs = cut(given.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    now = pairs.filter("u <> v")
    while not _stars(now):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        # Every larger neighbour of an id to the least id around it ...
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.distinct())
        # ... and then whatever an id points at, all smaller, to the least of these.
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(small.union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
    tops = now.select(F.col("v").alias("id")).distinct()
    found = now.select(F.col("u").alias("id"), F.col("v").alias("root")).union(tops.select("id", F.col("id").alias("root")))
    alone = pairs.filter("u = v").select(F.col("u").alias("id")).join(found, "id", "left_anti")
    return found.union(alone.select("id", F.col("id").alias("root")))
