"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topiclens.llm.common import cut


def _large_star(both: DataFrame) -> DataFrame:
    """Greater neighbours go to the least neighbour, or to the node itself if it is less.

    The least is found by an aggregate that combines before the shuffle and is joined back,
    so a node with very many neighbours is neither sorted nor held in one task.
    """
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        .distinct()
    )

def _small_star(links: DataFrame) -> DataFrame:
    """Lesser neighbours and the node itself go to the least."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    return (
        links.join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .where("u != v")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component): each linked node and the least node that it can reach.

    links: pairs (a, b) of comparable values, in any direction, repeated or not. Nulls and
    links of a node to itself say nothing. No links: no rows. Rounds are about the logarithm
    of the longest path; each round's links are written to the shared folder.
    """
    links = links.where("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    links = cut(links.distinct())
    mark = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        links = cut(_small_star(_large_star(both)))
        now = links.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
