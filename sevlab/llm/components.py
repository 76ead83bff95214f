"""Connected components of a link table by alternating large-star and small-star steps
(Kiveris et al., 2014): each step is an aggregation and a join, so no neighbourhood is gathered
into one task, and the number of rounds grows with the logarithm of the longest path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sevlab.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour greater than u is linked to the least of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the least of them. ``edges``: u greater than v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter(F.col("u") > F.col("v"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root): every linked node's least reachable node. ``links``: integer columns a and b."""
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter(F.col("u") > F.col("v"))
    edges = written(pairs.distinct(), "star")
    before, now = None, _mark(edges)
    while before != now and now[0]:
        edges = written(_small_star(_large_star(edges).distinct()).distinct(), "star")
        before, now = now, _mark(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
