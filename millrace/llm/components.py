"""Connected components of links, by alternating large and small stars.

Each round moves every link nearer to the smallest node of its component, by two aggregations and two joins; links are
made distinct and written to the shared folder after each round, so that lineage stays short and a lost executor costs
one round. Rounds grow with the logarithm of the longest chain. A node with very many links is an ordinary skewed join
key, which adaptive execution splits; its links are never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.workdir import checkpointed


def _large(links: DataFrame) -> DataFrame:
    """Link larger neighbours of every node to its smallest neighbour."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(links: DataFrame) -> DataFrame:
    """Link every node and its smaller neighbours to the smallest of them. Links go from large to small here."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a != b")


def _sum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node with a link; ``links`` has bigint columns a and b. The root is the smallest node."""
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    now = checkpointed(now)
    before = _sum(now)
    while before[0]:
        now = checkpointed(_small(_large(now).distinct()).distinct())
        after = _sum(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
