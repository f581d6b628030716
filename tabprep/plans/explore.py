"""The full look at a table: profile, correlations, distributions and box plots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.operators.corr import correlation
from tabprep.operators.distribution import box_stats, histogram, kde
from tabprep.operators.profile import Facts, profile, profile_long


def explore(df: DataFrame, corr_method: str = "pearson") -> dict[str, DataFrame]:
    """The profile tables plus correlation, histogram, density and box statistics, from one collection of facts."""
    facts = Facts.collect(df)
    return {
        **profile(df, facts),
        "correlation": correlation(df, corr_method),
        "histogram": histogram(df),
        "kde": kde(df),
        "box_stats": box_stats(df, quartiles=dict(facts.quartiles)),
    }


def explore_long(df: DataFrame, corr_method: str = "pearson") -> DataFrame:
    """``explore`` as one table ``(section, column, metric, value)``."""
    facts = Facts.collect(df)
    out = profile_long(df, facts)
    corr = correlation(df, corr_method).select(
        F.lit("correlation").alias("section"), F.col("col_a").alias("column"), F.col("col_b").alias("metric"),
        F.col("corr").alias("value"))
    bins = histogram(df).select(
        F.lit("histogram").alias("section"), "column", F.col("bin").cast("string").alias("metric"),
        F.col("count").cast("double").alias("value"))
    curve = kde(df).select(
        F.lit("kde").alias("section"), "column", F.col("point").cast("string").alias("metric"),
        F.col("density").alias("value"))
    box = box_stats(df, quartiles=dict(facts.quartiles))
    fields = [c for c in box.columns if c != "column"]
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in fields])
    boxes = box.select(F.lit("box_stats").alias("section"), "column", F.inline(cells))
    for part in (corr, bins, curve, boxes):
        out = out.unionByName(part)
    return out
