"""Values that once gave wrong answers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabprep.functions.text import parse_number
from tabprep.operators.corr import correlation
from tabprep.operators.iforest import IsolationForest, _drawn_copies
from tabprep.operators.outliers import bounds, count_outside, drop_outside
from tabprep.operators.quantiles import quantiles
from tabprep.operators.scale import Scaler
from tabprep.plans.registry import FOREST_PARTS, bagged


@pytest.mark.parametrize("name", ["std", "both", "n", "xy", "mean", "nulls"])
def test_pearson_does_not_depend_on_names(spark, name):
    rows = [(1.0, 10.0), (2.0, 35.0), (3.0, 22.0), (4.0, 41.0)]
    got = correlation(spark.createDataFrame(rows, f"a double, `{name}` double")).where(f"col_a = 'a' and col_b = '{name}'").first()["corr"]
    assert got == pytest.approx(0.7467, abs=1e-4)


def test_zscore_and_scaling_of_equal_values(spark):
    df = spark.range(1000).select(F.lit(0.1).alias("x"))
    limits = bounds(df, "zscore")
    assert limits["x"] == (0.1, 0.1)
    assert drop_outside(df, limits).count() == 1000 and count_outside(df, limits) == 0
    assert Scaler("standard").fit_transform(df).agg(F.max(F.abs("x"))).first()[0] == 0.0


def test_white_space_of_any_kind_around_numbers(spark):
    rows = [("\t5",), ("5\n",), (" 1,200 ",), ("5 5",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(parse_number(F.col("t")))
           .collect()]
    assert got == [5.0, 5.0, 1200.0, None, None]


def test_quantiles_leave_out_nan(spark):
    df = spark.range(300).select(F.when(F.col("id") % 2 == 0, F.col("id").cast("double")).otherwise(F.lit(float("nan"))).alias("x"))
    assert quantiles(df, ["x"], (0.0, 1.0))["x"] == {0.0: 0.0, 1.0: 298.0}


def test_forest_finds_rows_among_copies(spark):
    copies = spark.range(10 * 4000).select((F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 10 / 2).alias("y"))
    planted = spark.createDataFrame([(100.0 + i, -50.0 - i) for i in range(5)], "x double, y double")
    kept = IsolationForest(contamination=0.001).fit(copies.union(planted), ["x", "y"]).keep_inliers(copies.union(planted))
    assert kept.where("x > 50").count() == 0 and kept.count() >= 39_000


def test_bags_do_not_depend_on_splits(spark):
    lines = spark.range(1000).select("id", (F.col("id") * 7 % 13).alias("v"))
    parts = [bagged(lines.repartition(n), "id").select("*", F.spark_partition_id().alias("p")) for n in (2, 7)]
    assert parts[0].rdd.getNumPartitions() == FOREST_PARTS
    assert sorted(map(tuple, parts[0].collect())) == sorted(map(tuple, parts[1].collect()))


def test_forest_on_one_row_with_very_many_copies(spark):
    """Ten million equal rows are drawn by number, not made."""
    hot = spark.range(1).select(F.lit(1.0).alias("x"), F.lit(2.0).alias("y"), F.lit(10_000_000).alias("copies"))
    drawn = hot.select(_drawn_copies(0.0026)(F.col("copies"), F.lit(7)).alias("k"))
    assert abs(drawn.first()["k"] - 26_000) < 6 * 26_000 ** 0.5
    rows = spark.range(200_000).select(F.when(F.col("id") < 190_000, 1.0).otherwise(F.col("id") % 1000 / 100).alias("x"), F.lit(1.0).alias("y"))
    planted = spark.createDataFrame([(500.0 + i, -500.0) for i in range(3)], "x double, y double")
    forest = IsolationForest(trees=50, contamination=0.02)
    flags = forest.fit_flags(rows.union(planted), ["x", "y"])
    assert flags.where("x > 400 and outlier").count() == 3 and flags.count() == 200_003
    kept = forest.fit_keep(rows.union(planted), ["x", "y"])
    assert kept.count() == flags.where("not outlier").count() and kept.columns == ["x", "y"]
    assert forest.count_outliers(rows.union(planted), ["x", "y"]) == (200_003, flags.where("outlier").count())
