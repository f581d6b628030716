from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabprep.operators import corr as corr_module
from tabprep.operators import lookup as lookup_module
from tabprep.operators.corr import correlation, correlation_matrix
from tabprep.operators.distribution import box_fliers, box_stats, histogram, kde
from tabprep.operators.impute import Imputer
from tabprep.operators.profile import (
    describe, describe_datetimes, duplicate_count, missing_table, profile, skewness, skewness_by_size, table_info,
    top_values,
)
from tabprep.operators.regress import (
    ForestParams, assemble, cross_validate_linear, feature_columns, fit_forest, fit_linear, regression_metrics,
)
from tabprep.operators.split import assign_folds
from tabprep.operators.tune import Search, Space, Trial, median_prune, refit_best, search_forest, should_prune
from tabprep.plans.explore import explore
from tabprep.plans.training import RegressionFlow
from tests.conftest import values


def sample(spark, n=400, nulls=False):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 6, n).astype(float), "c": np.exp(rng.normal(size=n))})
    pdf["b"] += (pdf["a"] > 0)
    pdf.loc[: n // 3, "c"] = 2.0              # one value holds a third of the rows
    if nulls:
        pdf.loc[rng.random(n) < 0.2, "a"] = None
        pdf.loc[rng.random(n) < 0.2, "c"] = None
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double"), pdf


# ---- profile ----

def test_describe(spark):
    df, pdf = sample(spark, nulls=True)
    got = describe(df).toPandas().set_index("column")
    want = pdf.describe().T
    for c in pdf.columns:
        assert list(got.loc[c]) == pytest.approx(list(want.loc[c]), rel=1e-12)


def test_describe_datetimes(spark):
    df = spark.sql("select timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(id as decimal(18, 6))) t from range(11)")
    row = describe_datetimes(df).first()
    assert str(row["q50"]) == "2024-01-01 00:00:05" and str(row["mean"]) == "2024-01-01 00:00:05" and row["count"] == 11


def test_skewness(spark):
    df, pdf = sample(spark, nulls=True)
    got = {r["column"]: r["skewness"] for r in skewness(df).collect()}
    assert got == pytest.approx(pdf.skew().to_dict(), rel=1e-10)
    order = [r["column"] for r in skewness(df).collect()]
    assert order == list(pdf.skew().sort_values(ascending=False).index)
    assert [r["column"] for r in skewness_by_size(df).collect()] == list(pdf.skew().sort_values(key=abs).index)
    edge = spark.createDataFrame([(1.0, None, 1.0), (1.0, None, 2.0), (1.0, 3.0, None)], "k double, few double, two double")
    assert {r["column"]: r["skewness"] for r in skewness(edge).collect()} == {"k": 0.0, "few": None, "two": None}


def test_skewness_class(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, 1.0), (4.0, 100.0)], "even double, high double")
    assert {r["column"]: r["class"] for r in skewness(df).collect()} == {"even": "symmetric", "high": "high"}


def test_info_missing_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (1, None)], "a int, b string")
    assert values(table_info(df)) == [("a", "int", 4, 4), ("b", "string", 1, 4)]
    assert [tuple(r) for r in missing_table(df).collect()] == [("b", 3, 75.0)]
    assert duplicate_count(df).first()[0] == 2
    empty = df.limit(0)
    assert missing_table(empty).count() == 0 and duplicate_count(empty).first()[0] == 0
    assert table_info(empty).first()["rows"] == 0
    assert describe(empty).first()["q50"] is None


def test_top_values(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 3 + [("c",)] + [(None,)] * 9, "s string")
    assert values(top_values(df, 2)) == [("s", "a", 3, 1), ("s", "b", 3, 2)]


def test_profile_names(spark):
    df, _ = sample(spark)
    assert set(profile(df)) == {"info", "describe", "missing", "duplicates", "top_values", "skewness"}
    assert {"correlation", "histogram", "kde", "box_stats"} <= set(explore(df))


# ---- correlation ----

def _tau_b(x, y):
    s = tx = ty = 0
    for i, j in combinations(range(len(x)), 2):
        s += np.sign(x[i] - x[j]) * np.sign(y[i] - y[j])
        tx += x[i] == x[j]
        ty += y[i] == y[j]
    n0 = len(x) * (len(x) - 1) / 2
    return s / np.sqrt((n0 - tx) * (n0 - ty))


def _wide(df, method, **kw):
    return {(r["col_a"], r["col_b"]): r["corr"] for r in correlation(df, method, **kw).collect()}


@pytest.mark.parametrize("nulls", [False, True])
@pytest.mark.parametrize("method", ["pearson", "spearman"])
@pytest.mark.parametrize("size", [1_000_000, 40])
def test_correlation(spark, nulls, method, size):
    df, pdf = sample(spark, nulls=nulls)
    ranked = {}
    for a in pdf:
        for b in pdf:
            both = pdf[[a, b]].dropna() if a != b else pdf[[a]].dropna()
            if method == "spearman":
                both = both.rank()
            ranked[a, b] = np.corrcoef(both[a], both[b])[0, 1]
    for parts in (1, 9):
        assert _wide(df.repartition(parts), method, rows_per_bucket=size) == pytest.approx(ranked, rel=1e-9)


@pytest.mark.parametrize("nulls", [False, True])
@pytest.mark.parametrize("size", [1_000_000, 30])
def test_kendall(spark, nulls, size):
    df, pdf = sample(spark, 150, nulls)
    got = _wide(df, "kendall", rows_per_bucket=size)
    for a, b in combinations(pdf.columns, 2):
        both = pdf[[a, b]].dropna()
        assert got[a, b] == got[b, a] == pytest.approx(_tau_b(both[a].to_numpy(), both[b].to_numpy()), rel=1e-12)
        assert got[a, a] == 1.0


@pytest.mark.parametrize("method", ["spearman", "kendall"])
def test_rank_correlation_through_shuffled_lookups(spark, monkeypatch, method):
    df, _ = sample(spark, 150, True)
    want = _wide(df, method)
    monkeypatch.setattr(lookup_module, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(corr_module, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(corr_module, "heavy_keys", lambda counts, key, n, total: [2.0])
    assert _wide(df, method) == pytest.approx(want, rel=1e-12)


def test_correlation_edges(spark):
    df = spark.createDataFrame([(1.0, 0.1, None, 3.0), (2.0, 0.1, None, 3.0), (4.0, 0.1, None, None)],
                               "a double, k double, n double, part double")
    for method, diagonal in (("pearson", None), ("spearman", None), ("kendall", 1.0)):
        got = _wide(df, method)
        assert got["a", "k"] is None and got["a", "n"] is None and got["a", "part"] is None
        assert got["k", "k"] == diagonal and got["n", "n"] is None
    assert _wide(df, "pearson")["a", "a"] == 1.0
    with pytest.raises(ValueError):
        correlation(df, "cosine")
    assert correlation(df.limit(0), "pearson").where("corr is not null").count() == 0
    assert correlation(spark.createDataFrame([("x",)], "s string")).count() == 0
    assert correlation_matrix(correlation(df)).columns == ["col_a", "a", "k", "n", "part"]


# ---- distributions ----

@pytest.mark.parametrize("bins", [30, 7])
def test_histogram(spark, bins):
    df, pdf = sample(spark, nulls=True)
    got = histogram(df, bins=bins).toPandas()
    for c in pdf:
        mine = got[got["column"] == c].sort_values("bin")
        counts, edges = np.histogram(pdf[c].dropna(), bins=bins)
        assert list(mine["count"]) == list(counts)
        assert list(mine["low"]) == pytest.approx(list(edges[:-1])) and list(mine["high"]) == pytest.approx(list(edges[1:]))
        assert (mine["density"] * (mine["high"] - mine["low"])).sum() == pytest.approx(1)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(3.0, None), (3.0, None)], "k double, n double")
    got = histogram(df)
    assert got.count() == 30 and got.agg(F.sum("count")).first()[0] == 2
    assert got.agg(F.min("low"), F.max("high")).first() == (2.5, 3.5)
    assert histogram(df.select("n")).count() == 0 and kde(df).count() == 0


def _gaussian(x, points=200):
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), points)
    return np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))


@pytest.mark.parametrize("fineness,tolerance", [(64, 5e-10), (16, 2e-7), (512, 1e-12)])
def test_kde(spark, fineness, tolerance):
    """Within the stated bound of the sum over all values."""
    df, pdf = sample(spark, nulls=True)
    got = kde(df, fineness=fineness).toPandas()
    for c in pdf:
        want = _gaussian(pdf[c].dropna().to_numpy())
        mine = got[got["column"] == c].sort_values("point")["density"].to_numpy()
        assert len(mine) == 200 and np.abs(mine - want).max() < tolerance * want.max()


def test_kde_reach_is_below_rounding(spark):
    """Far apart values: most of the grid is out of reach of most values."""
    x = np.concatenate([np.arange(500) / 500, [1e3]])
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = np.array([r["density"] for r in kde(df).orderBy("point").collect()])
    want = _gaussian(x)
    assert np.abs(got - want).max() < 1e-9 * want.max() and (got[want < 1e-18 * want.max()] < 1e-17).all()


def test_box(spark):
    df, pdf = sample(spark, nulls=True)
    got = box_stats(df).toPandas().set_index("column")
    fliers = box_fliers(df).toPandas()
    for c in pdf:
        x = pdf[c].dropna()
        q1, q2, q3 = x.quantile([0.25, 0.5, 0.75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        row = got.loc[c]
        assert list(row[["q25", "median", "q75", "min", "whisker_low", "whisker_high", "max"]]) == pytest.approx(
            [q1, q2, q3, x.min(), inside.min(), inside.max(), x.max()])
        assert row["outliers"] == len(x) - len(inside) == (fliers["column"] == c).sum()
    nulls = spark.createDataFrame([(None,)], "v double")
    assert box_stats(nulls).first()["median"] is None and box_fliers(nulls).count() == 0


# ---- regression ----

def model_frame(spark, n=500):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"id": np.arange(n), "x": rng.normal(size=n), "z": rng.normal(size=n) * 10 + 3})
    pdf["y"] = 2 * pdf.x - 0.5 * pdf.z + 4 + rng.normal(size=n)
    return spark.createDataFrame(pdf), pdf


def test_linear(spark):
    df, pdf = model_frame(spark)
    model = fit_linear(df, "y", ["x", "z"])
    want = np.linalg.lstsq(np.column_stack([np.ones(len(pdf)), pdf.x, pdf.z]), pdf.y, rcond=None)[0]
    assert [model.intercept, *model.coefficients] == pytest.approx(list(want))
    row = regression_metrics(model.predict(df), "y").first()
    error = pdf.y - (want[0] + want[1] * pdf.x + want[2] * pdf.z)
    assert row["mse"] == pytest.approx((error ** 2).mean()) and row["mae"] == pytest.approx(error.abs().mean())
    assert row["r2"] == pytest.approx(1 - (error ** 2).sum() / ((pdf.y - pdf.y.mean()) ** 2).sum())
    assert feature_columns(df.withColumn("f", F.lit(True)).withColumn("s", F.lit("a")), "y") == ["id", "x", "z", "f"]


def test_metrics_edges(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (None, 3.0), (4.0, None)], "y double, prediction double")
    row = regression_metrics(df, "y").first()
    assert (row["rows"], row["mse"], row["r2"], row["mae"]) == (2, 0.5, None, 0.5)
    assert regression_metrics(df.limit(0), "y").first()["mse"] is None


def test_cross_validation(spark):
    df, _ = model_frame(spark)
    folded = assign_folds(df, ["id"])
    got = {r["fold"]: r["mse"] for r in cross_validate_linear(folded, "y", ["x", "z"], "fold").collect()}
    pdf = folded.toPandas()
    for f in range(5):
        fit, held = pdf[pdf.fold != f], pdf[pdf.fold == f]
        w = np.linalg.lstsq(np.column_stack([np.ones(len(fit)), fit.x, fit.z]), fit.y, rcond=None)[0]
        assert got[f] == pytest.approx(((held.y - w[0] - w[1] * held.x - w[2] * held.z) ** 2).mean())
    with pytest.raises(ValueError):
        cross_validate_linear(df.withColumn("fold", F.lit(0)), "y", ["x"], "fold")


def test_forest_and_search(spark):
    df, _ = model_frame(spark)
    table = assemble(df, ["x", "z"], ["y"])
    scored = fit_forest(table, "y", ForestParams(trees=5)).transform(table)
    assert regression_metrics(scored, "y").first()["r2"] > 0.6
    space = Space(trees=(2, 4, 2), max_depth=(2, 3), min_leaf=(1, 2), feature_share=(0.5, 1.0, 0.5))
    search = search_forest(df, "y", ["x", "z"], ["id"], trials=3, folds=2, parallelism=2, space=space)
    again = search_forest(df, "y", ["x", "z"], ["id"], trials=3, folds=2, parallelism=1, space=space)
    assert [t.value for t in search.trials] == pytest.approx([t.value for t in again.trials])
    assert search.best.value == min(t.value for t in search.trials)
    assert search.table(df).count() == 6
    assert refit_best(df, "y", ["x", "z"], search)[1].first()["rows"] == 500


def test_space():
    drawn = Space().draw(200, 42)
    assert drawn == Space().draw(200, 42)
    assert {p.trees % 100 for p in drawn} == {0} and max(p.max_depth for p in drawn) <= 30
    assert all(0.2 <= p.feature_share <= 1.0 for p in drawn)


def test_pruning(spark):
    assert not should_prune([9.0], [[1.0]] * 4)
    assert should_prune([9.0], [[1.0]] * 5) and not should_prune([9.0, 0.5], [[1.0, 1.0]] * 5)
    assert not should_prune([1.0], [[1.0]] * 5)
    trials = (Trial(0, ForestParams(), (3.0,), True), Trial(1, ForestParams(), (5.0, 5.0), False))
    assert Search(trials).best.number == 1
    reports = spark.createDataFrame([(t, 1, float(v)) for t, v in enumerate([1, 2, 3, 4, 5, 9, 1])], "trial int, step int, running_mean double")
    got = {r["trial"]: r["prune"] for r in median_prune(reports).collect()}
    assert got == {0: False, 1: False, 2: False, 3: False, 4: False, 5: True, 6: False}


# ---- the whole flow ----

def test_flow(spark):
    df, _ = model_frame(spark)
    dirty = df.withColumn("x", F.when(F.col("id") % 10 != 0, F.col("x")))
    flow = RegressionFlow("y", ["id"], absolute=False, outlier_exclude=["z"])
    row, again = flow.run(dirty).first(), flow.run(dirty.repartition(13)).first()
    assert row["r2"] > 0.8 and row["n_train"] + row["n_test"] <= 500
    assert list(row) == pytest.approx(list(again))
    trained, _, test = flow.fit(dirty)
    assert test.where("x is null").count() == 0
    assert trained.predict(dirty.limit(3)).where("prediction is null").count() == 0


@pytest.mark.parametrize("method", [None, "zscore", "isolation_forest"])
def test_flow_outlier_methods(spark, method):
    df, _ = model_frame(spark, 300)
    row = RegressionFlow("y", ["id"], absolute=False, outlier_method=method, scaling="minmax",
                         imputer=Imputer("mean")).run(df).first()
    assert row["r2"] > 0.8
    with pytest.raises(ValueError):
        RegressionFlow("y", ["id"], outlier_strategy="isolation_forest").run(df)


def test_label_is_left_alone_unless_asked(spark):
    df, _ = model_frame(spark, 200)
    dirty = df.withColumn("y", F.when(F.col("id") % 9 != 0, F.col("y")))
    kept = RegressionFlow("y", ["id"], absolute=False).fit(dirty)[2]
    filled = RegressionFlow("y", ["id"], absolute=False, impute_label=True).fit(dirty)[2]
    assert kept.where("y is null").count() > 0 and filled.where("y is null").count() == 0
