"""Connected components of a link table, as repeated joins (large star, small star).

Each round lowers labels through joins and writes its links to the shared scratch folder; the driver sees
two numbers a round (how many links there are, and their checksum), which tell when nothing changes any more. The number of
rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import write_scratch


def _star(links: DataFrame) -> DataFrame:
    """Large star: every node's larger neighbours point to its smallest neighbour (or itself)."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return large.where("a <> b").distinct()


def _small(links: DataFrame) -> DataFrame:
    """Small star: every node's smaller neighbours, and the node itself, point to the smallest of them. Links have a > b."""
    low = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) of any orderable type to (node, component): each linked node with the smallest node it can reach."""
    links = links.where("a is not null and b is not null and a <> b")
    now = write_scratch(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    was = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == was or not seen[0]:
            break
        was = seen
        now = write_scratch(_small(_star(now)), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
