"""The tables behind histograms, density curves and box plots."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.operators.outliers import iqr_fence
from tabprep.operators.profile import QUARTILES
from tabprep.operators.quantiles import quantiles
from tabprep.operators.roles import numeric_columns
from tabprep.operators.stats import col, numeric_summary, one_row

BINS = 30
GRID_POINTS = 200
FINENESS = 64         # bins per bandwidth
REACH = 9.0           # bandwidths; a Gaussian beyond is below the rounding of the sum


def histogram(df: DataFrame, cols: Sequence[str] | None = None, bins: int = BINS) -> DataFrame:
    """``(column, bin, low, high, count, density)`` with equal bins from minimum to maximum, the last one closed.

    Values are binned in place and counted on the map side, so only the bin counts are shuffled.
    """
    names = numeric_columns(df, cols)
    stats = numeric_summary(df, names, ("count", "min", "max"))
    edges = {}
    for c in names:
        if stats[c]["count"]:
            lo, hi = stats[c]["min"], stats[c]["max"]
            edges[c] = (lo, hi) if hi > lo else (lo - 0.5, hi + 0.5)
    spark = df.sparkSession
    rows = [(c, lo, (hi - lo) / bins, hi, stats[c]["count"]) for c, (lo, hi) in edges.items()]
    frame = spark.createDataFrame(rows, "column string, start double, width double, stop double, total bigint")
    grid = frame.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    if not edges:
        cells = spark.createDataFrame([], "column string, bin int, count bigint")
    else:
        binned = F.array(*[
            F.struct(F.lit(c).alias("column"), _bin_of(col(c).cast("double"), lo, (hi - lo) / bins, bins).alias("bin"))
            for c, (lo, hi) in edges.items()
        ])
        cells = (
            df.select(F.inline(binned)).where(F.col("bin").isNotNull())
            .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count"))
        )
    low = F.col("start") + F.col("bin") * F.col("width")
    count = F.coalesce("count", F.lit(0))
    return grid.join(F.broadcast(cells), ["column", "bin"], "left").select(   # at most bins rows per column
        "column", "bin", low.alias("low"),
        F.when(F.col("bin") == bins - 1, F.col("stop")).otherwise(
            F.col("start") + (F.col("bin") + 1) * F.col("width")).alias("high"),
        count.cast("bigint").alias("count"),
        (count / (F.col("total") * F.col("width"))).alias("density"),
    )


def _bin_of(x: Column, start: float, width: float, bins: int) -> Column:
    # least() skips nulls, so a missing value must be kept out by hand.
    guess = F.when(x.isNotNull(), F.least(F.floor((x - start) / width), F.lit(bins - 1))).cast("int")
    # The quotient can land one bin off at an edge; the edges themselves decide.
    return (
        F.when(x < start + guess * width, guess - 1)
        .when((guess < bins - 1) & (x >= start + (guess + 1) * width), guess + 1)
        .otherwise(guess)
    )


def kde(
    df: DataFrame, cols: Sequence[str] | None = None, points: int = GRID_POINTS, fineness: int = FINENESS,
) -> DataFrame:
    """``(column, point, x, density)``: Gaussian density by Scott's rule on an even grid from minimum to maximum.

    One scan counts all columns in bins of a ``fineness``-th of the bandwidth, with the first three moments of the values
    about the middle of their bin; only these are shuffled, whatever the rows. A bin adds to the grid points within
    ``REACH`` bandwidths by the expansion of the kernel to the third order, so the error is below
    ``(1 / (2 * fineness)) ** 4 / 8`` of the kernel's peak, 5e-10 by default, and below 3e-18 of it for what lies farther off.
    """
    names = numeric_columns(df, cols)
    stats = numeric_summary(df, names, ("count", "std", "min", "max"))
    setup = {}
    for c in names:
        s = stats[c]
        if s["count"] and s["count"] > 1 and s["std"]:
            setup[c] = (s["min"], (s["max"] - s["min"]) / (points - 1), s["std"] * s["count"] ** -0.2, s["count"])
    spark = df.sparkSession
    frame = spark.createDataFrame(
        [(c, *v) for c, v in setup.items()], "column string, start double, step double, width double, total bigint")
    if not setup:
        sums = spark.createDataFrame([], "column string, point int, total_weight double")
    else:
        cells = []
        for c, (start, _, width, _) in setup.items():
            place = (col(c).cast("double") - start) / width * fineness
            cells.append(F.struct(F.lit(c).alias("column"), F.floor(place).alias("bin"), place.alias("place")))
        d = (F.col("place") - F.col("bin") - 0.5) / fineness              # from the middle of the bin, in bandwidths
        bins = (
            df.select(F.inline(F.array(*cells))).where(F.col("place").isNotNull()).select("column", "bin", d.alias("d"))
            .groupBy("column", "bin").agg(
                F.count(F.lit(1)).alias("n"), F.sum("d").alias("d1"), F.sum(F.expr("d * d")).alias("d2"), F.sum(F.expr("d * d * d")).alias("d3"))
            .join(F.broadcast(frame), "column"))                           # one row per column
        middle, per = (F.col("bin") + 0.5) / fineness, F.col("step") / F.col("width")
        first = F.greatest(F.ceil((middle - REACH) / per), F.lit(0)).cast("int")
        last = F.least(F.floor((middle + REACH) / per), F.lit(points - 1)).cast("int")
        near = bins.select(
            "column", "n", "d1", "d2", "d3", middle.alias("middle"), per.alias("per"), F.explode(F.when(first <= last, F.sequence(first, last))).alias("point"))
        z = F.col("point") * F.col("per") - F.col("middle")
        near = near.withColumn("z", z)
        weight = F.expr("exp(-0.5D * z * z) * (n + z * d1 + (z * z - 1) / 2 * d2 + (z * z - 3) * z / 6 * d3)")
        sums = near.groupBy("column", "point").agg(F.sum(weight).alias("total_weight"))
    grid = frame.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    return grid.join(F.broadcast(sums), ["column", "point"], "left").select(   # points rows per column
        "column", "point", (F.col("start") + F.col("point") * F.col("step")).alias("x"),
        (F.coalesce("total_weight", F.lit(0.0)) / (F.col("total") * F.col("width") * math.sqrt(2 * math.pi))).alias("density"),
    )


def box_stats(
    df: DataFrame, cols: Sequence[str] | None = None, quantile_method: str = "exact",
    quartiles: dict[str, dict[float, float | None]] | None = None,
) -> DataFrame:
    """Minimum, quartiles, maximum, whisker ends (extremes within 1.5 IQR) and number of outliers per column."""
    names = numeric_columns(df, cols)
    mid = quartiles or quantiles(df, names, QUARTILES, quantile_method)
    exprs = {}
    for c in names:
        lo, hi = iqr_fence(mid[c][0.25], mid[c][0.75])
        if lo is None:
            continue
        x = col(c).cast("double")
        within = F.when(x.between(lo, hi), x)
        exprs[c, "min"], exprs[c, "max"] = F.min(x), F.max(x)
        exprs[c, "whisker_low"], exprs[c, "whisker_high"] = F.min(within), F.max(within)
        exprs[c, "outliers"] = F.count_if((x < lo) | (x > hi))
    got = one_row(df, exprs)
    fields = ("min", "whisker_low", "whisker_high", "max", "outliers")
    rows = [
        (c, *[mid[c][q] for q in QUARTILES], *[got.get((c, f)) for f in fields]) for c in names
    ]
    return df.sparkSession.createDataFrame(
        rows, "column string, q25 double, median double, q75 double, min double, whisker_low double, "
              "whisker_high double, max double, outliers bigint")


def box_fliers(
    df: DataFrame, cols: Sequence[str] | None = None, quantile_method: str = "exact",
) -> DataFrame:
    """``(column, value)`` of every value beyond 1.5 IQR from the quartiles."""
    names = numeric_columns(df, cols)
    mid = quantiles(df, names, (0.25, 0.75), quantile_method)
    fences = {c: iqr_fence(mid[c][0.25], mid[c][0.75]) for c in names if mid[c][0.25] is not None}
    if not fences:
        return df.sparkSession.createDataFrame([], "column string, value double")
    outside = F.array(*[
        F.struct(F.lit(c).alias("column"), F.when((col(c) < lo) | (col(c) > hi), col(c).cast("double")).alias("value"))
        for c, (lo, hi) in fences.items()
    ])
    return df.select(F.inline(outside)).where(F.col("value").isNotNull())
