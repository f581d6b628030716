"""Linear and random-forest regression, predictions and metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.operators.stats import col

FEATURES = "__features"


def feature_columns(df: DataFrame, label: str) -> list[str]:
    """Every column a model can take apart from the label: numbers and booleans."""
    usable = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema if f.name != label and isinstance(f.dataType, usable)]


def assemble(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The kept columns and one vector of the features. A null among them is an error, raised when it is met."""
    numbers = df.select(
        *[col(k) for k in keep], *[col(f).cast("double").alias(f"__f{i}") for i, f in enumerate(features)])
    build = VectorAssembler(
        inputCols=[f"__f{i}" for i in range(len(features))], outputCol=FEATURES, handleInvalid="error")
    return build.transform(numbers).select(*[col(k) for k in keep], FEATURES)


@dataclass(frozen=True)
class LinearModel:
    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def expression(self) -> Column:
        total = F.lit(self.intercept)
        for name, weight in zip(self.features, self.coefficients):
            total = total + col(name).cast("double") * F.lit(weight)
        return total

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Add the prediction: a projection of literals, without vectors."""
        return df.withColumn(name, self.expression())

    def table(self, df: DataFrame) -> DataFrame:
        rows = [("intercept", self.intercept), *zip(self.features, self.coefficients)]
        return df.sparkSession.createDataFrame(rows, "term string, estimate double")


def fit_linear(df: DataFrame, label: str, features: Sequence[str] | None = None) -> LinearModel:
    """Least squares with intercept, from the normal equations summed in one pass."""
    features = list(features or feature_columns(df, label))
    labelled = df.where(col(label).isNotNull()).withColumn("__label", col(label).cast("double"))
    fit = LinearRegression(featuresCol=FEATURES, labelCol="__label", solver="auto").fit(
        assemble(labelled, features, ["__label"]))
    return LinearModel(tuple(features), tuple(float(x) for x in fit.coefficients), float(fit.intercept))


def metric_exprs(label: Column, prediction: Column) -> dict[str, Column]:
    """Row count, MSE, R² and MAE as aggregates over the rows that have both values."""
    both = label.isNotNull() & prediction.isNotNull()
    y = F.when(both, label.cast("double"))
    error = y - prediction
    rows = F.count(y)
    return {
        "rows": rows,
        "mse": F.avg(error * error),
        "r2": 1 - F.sum(error * error) / F.nullif(F.var_pop(y) * rows, F.lit(0.0)),
        "mae": F.avg(F.abs(error)),
    }


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row ``(rows, mse, r2, mae)``, in one scan."""
    return df.agg(*[e.alias(n) for n, e in metric_exprs(col(label), col(prediction)).items()])


@dataclass(frozen=True)
class ForestParams:
    trees: int = 100
    max_depth: int = 5
    min_leaf: int = 1
    feature_share: float = 1.0
    seed: int = 42


def fit_forest(assembled: DataFrame, label: str, params: ForestParams) -> RandomForestRegressionModel:
    """A random forest on a table from ``assemble``; trees grow level by level across all partitions."""
    return RandomForestRegressor(
        featuresCol=FEATURES, labelCol=label, numTrees=params.trees, maxDepth=params.max_depth,
        minInstancesPerNode=params.min_leaf, featureSubsetStrategy=str(float(params.feature_share)), seed=params.seed,
    ).fit(assembled)


def cross_validate_linear(df: DataFrame, label: str, features: Sequence[str], fold: str) -> DataFrame:
    """``(fold, rows, mse, r2, mae)`` of least squares fitted on all other folds, in two scans for any number of folds.

    The first scan sums means and co-moments per fold; the moments of "all folds but one" are merged from them on
    the driver. The second scan scores each row with the coefficients of its own fold.
    """
    names = [*features, label]
    present = df.dropna(subset=names).select(col(fold).alias("__fold"), *[col(c).cast("double").alias(c) for c in names])
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = present.groupBy("__fold").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(names)],
        *[F.covar_pop(col(names[i]), col(names[j])).alias(f"c{i}_{j}") for i, j in pairs])
    moments = {}
    for row in sums.collect():       # one row per fold
        co = np.zeros((len(names), len(names)))
        for i, j in pairs:
            co[i, j] = co[j, i] = row[f"c{i}_{j}"] * row["n"]
        moments[row["__fold"]] = (row["n"], np.array([row[f"m{i}"] for i in range(len(names))]), co)
    models = {f: _solve(_merge([m for g, m in moments.items() if g != f]), features) for f in moments}
    prediction = F.lit(None).cast("double")
    for f, model in models.items():
        prediction = F.when(F.col("__fold") == F.lit(f), model.expression()).otherwise(prediction)
    scored = present.withColumn("__prediction", prediction)
    return scored.groupBy(F.col("__fold").alias("fold")).agg(
        *[e.alias(n) for n, e in metric_exprs(col(label), F.col("__prediction")).items()])


def _merge(parts: Sequence[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Pool counts, means and co-moments of disjoint parts."""
    if not parts:
        raise ValueError("cross-validation needs rows in at least two folds")
    total, mean, co = parts[0]
    for n, other_mean, other_co in parts[1:]:
        gap = other_mean - mean
        co = co + other_co + np.outer(gap, gap) * (total * n / (total + n))
        mean = mean + gap * (n / (total + n))
        total += n
    return total, mean, co


def _solve(moments: tuple[int, np.ndarray, np.ndarray], features: Sequence[str]) -> LinearModel:
    _, mean, co = moments
    slopes = np.linalg.lstsq(co[:-1, :-1], co[:-1, -1], rcond=None)[0]
    return LinearModel(tuple(features), tuple(float(s) for s in slopes), float(mean[-1] - slopes @ mean[:-1]))


def mean_score(folds: DataFrame) -> DataFrame:
    """One row: the number of folds and the mean of their MSEs."""
    return folds.agg(F.count(F.lit(1)).alias("folds"), F.avg("mse").alias("mean_mse"))


def params_row(params: ForestParams) -> Mapping[str, float]:
    return {
        "trees": params.trees, "max_depth": params.max_depth, "min_leaf": params.min_leaf,
        "feature_share": params.feature_share,
    }
