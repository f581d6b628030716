"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import checkpointed


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Link neighbours to the least of a node's neighbourhood: larger ones, or the node and its smaller ones."""
    both = edges if small else edges.union(edges.select("v", "u"))
    if small:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "__u")
    joined = both.join(least, F.col("u") == F.col("__u"))
    if small:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
    else:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of the edges ``u``, ``v``.

    Runs until the edges are stars around the roots, a number of rounds logarithmic in the size of the largest
    component. A node with very many edges is aggregated in the map tasks and split by the adaptive join.
    """
    now = checkpointed(edges.filter(F.col("u") != F.col("v")).select("u", "v").distinct())
    mark = None
    while True:
        now = checkpointed(_stars(_stars(now, small=False), small=True))
        again = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.hash("v", "u").cast("bigint"))).first()
        if again == mark:
            break
        mark = again
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
