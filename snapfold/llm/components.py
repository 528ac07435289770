"""Connected components by alternating large and small stars, every round a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.llm.common import stage


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)`` of every node of an edge; ``component`` is the smallest node.

    ``edges``: two columns of longs, undirected; loops, repeats and nulls are
    ignored.  A round hangs every node on the smallest of its neighbours, first
    its larger neighbours (large star), then its smaller ones (small star);
    rounds grow with the logarithm of the longest path.  Minima are partially
    aggregated, and both sides of each join are stored tables, so that a hub's
    rows can be split over tasks.
    """
    a, b = edges.columns
    pairs = (
        edges.toDF("u", "v")
        .where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    pairs = stage(pairs, label)
    mark = _mark(pairs)
    while mark[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), label)
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), label)
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), label)
        small = large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        pairs = stage(small, label)
        before, mark = mark, _mark(pairs)
        if mark == before:
            break
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(pairs: DataFrame) -> tuple:
    """Count and order-free sum of hashes: equal for equal sets of pairs."""
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(pairs.agg(F.count("*"), F.sum(hashed), F.sum(F.col("v").cast("decimal(38,0)"))).first())
