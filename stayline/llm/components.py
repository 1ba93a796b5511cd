"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest node around it."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them; ``links`` run from larger to smaller."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v), the root being the smallest node it can reach.

    Rounds end when the links no longer change; their number grows with the
    logarithm of the nodes. Lineage is cut after each round.
    """
    current = stored(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    mark = _mark(current)
    while True:
        current = stored(_small_star(_large_star(current).filter("u <> v").distinct()).distinct(), "links")
        seen, mark = mark, _mark(current)
        if seen == mark:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _mark(links: DataFrame) -> tuple:
    """Number of links and a sum over their hashes: equal when nothing moved."""
    hashed = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(links.agg(F.count("*"), F.sum(hashed)).first())
