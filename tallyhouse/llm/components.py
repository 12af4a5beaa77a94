"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.sources.staging import stage


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for every node that has a link.

    Large-star and small-star steps in turn: every node hands its neighbours to the smallest of them,
    until only stars are left, after about as many rounds as the logarithm of the longest path. Each
    step takes a minimum per node, combined before its shuffle and staged, and one join of staged tables, which
    the adaptive plan can split at a hot node; the links are staged between rounds. Nodes are whole numbers; a link from a
    node to itself, a repeated link and an empty table are allowed.
    """
    pairs = links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).where("v <> u").distinct()
    pairs = stage(pairs, "links")
    before = _digest(pairs)
    while True:
        # Large star: the larger neighbours of a node link to the smallest node around it.
        both = pairs.select("v", "u").union(pairs.select(F.col("u").alias("v"), F.col("v").alias("u")))
        around = stage(both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m")), "least")
        large = both.join(around, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        # Small star: a node and its smaller neighbours link to the smallest of them.
        large = stage(large, "links")
        least = stage(large.groupBy("v").agg(F.min("u").alias("m")), "least")
        small = large.join(least, "v")
        small = small.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")).union(
            least.select("v", F.col("m").alias("u"))
        )
        pairs = stage(small.distinct(), "links")
        after = _digest(pairs)
        if after == before:
            return pairs.select(F.col("v").alias("node"), F.col("u").alias("root"))
        before = after


def _digest(pairs: DataFrame) -> tuple:
    """Equal for equal sets of links, whatever their order."""
    mixed = F.xxhash64("v", "u")
    row = pairs.agg(
        F.count(F.lit(1)), F.sum(mixed.cast("decimal(38,0)")), F.bit_xor(mixed), F.sum(F.col("u").cast("decimal(38,0)"))
    ).first()
    return tuple(row)
