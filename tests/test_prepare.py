from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabprep.operators.encode import LabelEncoder, OneHotEncoder, encode_categorical
from tabprep.operators.iforest import IsolationForest
from tabprep.operators.impute import Imputer, modes
from tabprep.operators.ordered import BUCKET, OrderedBuckets, fill, running_before
from tabprep.operators.outliers import bounds, clip_to, count_outside, drop_outside, handle_outliers, outlier_report
from tabprep.operators.quantiles import exact_quantiles, order_statistics, quantiles
from tabprep.operators.roles import ColumnRoles
from tabprep.operators.scale import Scaler
from tabprep.operators.split import assign_folds, split_exact, split_hash
from tests.conftest import values


def frame(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "k": np.arange(n), "flat": rng.integers(0, 4, n).astype(float), "wide": rng.normal(size=n) * 100,
        "tail": np.exp(rng.normal(size=n) * 3),
    })
    # A third of the rows share one value, right where a quartile falls.
    pdf.loc[: n // 3, "wide"] = 7.0
    pdf.loc[rng.random(n) < 0.1, "tail"] = None
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "k bigint, flat double, wide double, tail double"), pdf


# ---- quantiles ----

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def test_exact_quantiles_have_the_bits_of_percentile(spark):
    df, pdf = frame(spark)
    cols = ["flat", "wide", "tail"]
    want = df.agg(*[F.percentile(c, PROBS).alias(c) for c in cols]).first()
    for parts in (1, 17):
        got = exact_quantiles(df.repartition(parts), cols, PROBS)
        assert all([got[c][p] for p in PROBS] == list(want[c]) for c in cols)


def test_quantiles_of_hard_columns_in_five_jobs(spark):
    """Values that share most of their bits, of both signs and all sizes, and ties, each against a sort."""
    rng = np.random.default_rng(4)
    n = 3001
    powers = np.array([2.0 ** e for e in range(-1074, 1024)])
    drawn = rng.integers(-2 ** 63, 2 ** 63 - 1, 9000).view(np.float64)
    hard = {
        "bits": drawn[~np.isnan(drawn)][:n], "powers": rng.permutation(np.concatenate([powers, -powers, np.nextafter(powers, 0)]))[:n],
        "close": 1.0 + rng.integers(0, 5000, n) * 2.0 ** -52, "sized": rng.normal(size=n) * 10.0 ** rng.integers(-300, 300, n),
        "tied": rng.integers(-2, 3, n).astype(float), "tiny": rng.integers(-9, 9, n) * 5e-324, "far": np.where(rng.random(n) < 0.4, -np.inf, np.inf)}
    pdf = pd.DataFrame(hard)
    df = spark.createDataFrame(pdf)
    tracker, group = spark.sparkContext.statusTracker(), "quantile-jobs"
    spark.sparkContext.setJobGroup(group, "quantiles")
    ranks = order_statistics(df, {c: range(0, n, 50) for c in hard})
    spark.sparkContext.setJobGroup(group + "-2", "quantiles")
    exact_quantiles(df, list(hard), (0.25, 0.5, 0.75))
    jobs = tracker.getJobIdsForGroup(group + "-2")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for c, v in hard.items():
        ordered = np.sort(v)
        assert ranks[c] == {k: ordered[k] for k in range(0, n, 50)}
    results = [j for j in jobs if len(tracker.getJobInfo(j).stageIds) > 2]        # of a query's jobs, the one that ends it
    assert len(results) <= 5


def test_order_statistics_of_longs(spark):
    df = spark.range(1000).select(((F.col("id") * 7919 % 1000) - 500 + (1 << 60)).alias("v"))
    assert order_statistics(df, {"v": [0, 499, 999, 5000]}, whole=True) == {
        "v": {0: (1 << 60) - 500, 499: (1 << 60) - 1, 999: (1 << 60) + 499}}


def test_quantile_edges(spark):
    empty = spark.createDataFrame([], "v double")
    assert exact_quantiles(empty, ["v"], [0.5]) == {"v": {0.5: None}}
    one = spark.createDataFrame([(4.0,), (None,)], "v double")
    assert exact_quantiles(one, ["v"], [0.25, 0.5])["v"] == {0.25: 4.0, 0.5: 4.0}
    assert quantiles(one, ["v"], [0.5], "approx")["v"][0.5] == 4.0
    with pytest.raises(ValueError):
        quantiles(one, ["v"], [0.5], "guess")


# ---- ordered ----

def gaps(spark, n=2000, hot=False):
    rng = np.random.default_rng(3)
    ts = np.where(np.arange(n) % 3 == 0, 500, np.arange(n)) if hot else rng.permutation(n)
    pdf = pd.DataFrame({"ts": ts, "id": np.arange(n), "g": rng.integers(0, 5, n), "v": rng.random(n)})
    pdf.loc[rng.random(n) < 0.7, "v"] = None
    pdf.loc[(pdf.ts > 800) & (pdf.ts < 1300), "v"] = None
    pdf.loc[pdf.ts < 100, "v"] = None
    rows = [(int(a), int(b), int(c), None if pd.isna(d) else float(d)) for a, b, c, d in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "ts bigint, id bigint, g int, v double"), pdf


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("direction", ["forward", "backward"])
@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("size", [50, 10_000])
def test_fill(spark, hot, direction, by, size):
    df, pdf = gaps(spark, hot=hot)
    got = fill(df, ["v"], ["ts", "id"], by, direction, size).toPandas().sort_values("id")["v"].to_numpy()
    ordered = pdf.sort_values(["ts", "id"])
    source = ordered.groupby("g")["v"] if by else ordered["v"]
    want = (source.ffill() if direction == "forward" else source.bfill()).reindex(pdf.index).to_numpy()
    np.testing.assert_array_equal(got, want)


def bucket_sizes(df, keys, size):
    return [r[0] for r in OrderedBuckets.fit(df, keys, size).tag(df).groupBy(BUCKET).count().select("count").collect()]


def test_hot_order_value_is_cut_further(spark):
    df, _ = gaps(spark, hot=True)
    assert max(bucket_sizes(df, ["ts", "id"], 50)) <= 100           # the value alone holds a third of 2,000 rows


ORDERS = {
    "text": "if(id % 3 = 0, null, repeat('prefix', 3) || if(id % 5 < 3, 'hot', conv(id * 7919 % 1000, 10, 36)))",
    "long": "(1L << 60) + id % 7", "double": "case when id % 9 = 0 then double('nan') when id % 9 = 1 then null "
    "when id % 9 = 2 then -0d when id % 9 = 3 then 0d when id % 9 = 4 then double('-inf') else id % 40 / 3d end",
    "flag": "id % 3 = 0", "day": "date'2024-01-01' + int(id % 4)", "decimal": "cast(id % 5 as decimal(30,2)) + 1e20bd",
    "constant": "1"}


@pytest.mark.parametrize("kind,direction,by", [(k, "forward", []) for k in ORDERS] + [("text", "backward", ["g"]), ("double", "backward", [])])
def test_fill_by_keys_of_any_type_and_ties(spark, kind, direction, by):
    """Against one window over all rows, with the hash of the row behind the keys."""
    df = spark.range(1500).selectExpr("id", f"{ORDERS[kind]} as k", "if(id % 4 = 0, id, null) as v", "if(id % 11 = 0, string(id), null) as s", "id % 2 as g")
    every = [F.col(c) for c in df.columns]
    tie = F.xxhash64(*every, *[c.isNull() for c in every])
    keys = [F.col("k").asc_nulls_first(), tie] if direction == "forward" else [F.col("k").desc_nulls_last(), tie.desc()]
    window = Window.partitionBy(*(by or [F.lit(0)])).orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", *[F.last(c, ignorenulls=True).over(window).alias(c) for c in ("v", "s")])
    got = fill(df, ["v", "s"], ["k"], by, direction, rows_per_bucket=150).select("id", "v", "s")
    assert values(got) == values(want)


def test_rows_on_one_order_value_make_even_buckets(spark):
    df = spark.range(20_000).selectExpr("1 as k", "id", "if(id % 3 = 0, id, null) as v").withColumn("h", F.xxhash64("id"))
    for keys in (["k", "h"], ["h"], ["k", "id"]):
        sizes = sorted(bucket_sizes(df, keys, 500))
        assert len(sizes) >= 30 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_hot_partition_is_carried_over_many_buckets(spark):
    df = spark.range(3000).selectExpr("id", "if(id % 10 < 8, 'hot', 'p' || id % 10) as p", "if(id = 2000 or id % 701 = 0, id, null) as v")
    got = fill(df, ["v"], ["id"], ["p"], rows_per_bucket=100).toPandas().sort_values("id")
    want = df.toPandas().sort_values("id")
    want["v"] = want.groupby("p")["v"].ffill()
    pd.testing.assert_series_equal(got["v"].reset_index(drop=True), want["v"].reset_index(drop=True))


def test_fill_timestamps_and_errors(spark):
    df = spark.sql("select timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, id) t, id, if(id % 4 = 0, id, null) v "
                   "from range(200)")
    got = [r["v"] for r in fill(df, ["v"], ["t"], rows_per_bucket=20).orderBy("t").collect()]
    assert got == [i // 4 * 4 for i in range(200)]
    with pytest.raises(ValueError):
        fill(df, ["v"], [])
    with pytest.raises(ValueError):
        fill(df, ["v"], ["t"], direction="up")
    with pytest.raises(ValueError):
        fill(df.withColumn("s", F.array("id")), ["v"], ["s"], rows_per_bucket=20)


def test_null_order_keys_and_null_partitions(spark):
    df = spark.createDataFrame([(None, 1.0, None), (1, None, None), (2, None, "p"), (3, 5.0, "p")], "k int, v double, p string")
    assert [r["v"] for r in fill(df, ["v"], ["k"]).orderBy("k").collect()] == [1.0, 1.0, 1.0, 5.0]
    assert [r["v"] for r in fill(df, ["v"], ["k"], ["p"], rows_per_bucket=1).orderBy("k").collect()] == [1.0, 1.0, None, 5.0]


def test_running_before(spark):
    df = spark.range(500).withColumnRenamed("id", "key").repartition(7)
    buckets = OrderedBuckets.fit(df, ["key"], 30)
    assert not buckets.single
    got = values(running_before(df, "key", {"b": "2L"}, buckets))
    assert got == [(i, 2 * i) for i in range(500)]


# ---- impute ----

def test_imputer_uses_training_statistics(spark):
    train = spark.createDataFrame([(1.0, "a"), (3.0, "a"), (None, "b")], "v double, s string")
    test = spark.createDataFrame([(None, None), (9.0, "c")], "v double, s string")
    model = Imputer("mean", "mode").fit(train)
    assert values(model.transform(test)) == [(2.0, "a"), (9.0, "c")]


def test_columns_without_training_nulls_are_filled_too(spark):
    model = Imputer("median", "constant").fit(spark.createDataFrame([(1, "a"), (2, "b")], "v int, s string"))
    assert values(model.transform(spark.createDataFrame([(None, None)], "v int, s string"))) == [(1.5, "Unknown")]


def test_modes(spark):
    df = spark.createDataFrame([(2, "b", None), (2, "a", None), (1, "a", None), (1, "b", None), (None, None, None)],
                               "i int, s string, n double")
    assert modes(df, ["i", "s", "n"]) == {"i": 1, "s": "a"}
    filled = Imputer("mode", "mode").fit_transform(df)
    assert filled.where("i is null or s is null").count() == 0
    assert filled.where("n is null").count() == 5
    assert dict(filled.dtypes)["i"] == "int"


def test_empty_category_becomes_unknown(spark):
    df = spark.createDataFrame([(None,), (None,)], "s string")
    assert values(Imputer(cat_strategy="mode").fit_transform(df)) == [("Unknown",), ("Unknown",)]


def test_drop_and_exclusion(spark):
    df = spark.sql("select * from values (1d, 'a', timestamp '2024-01-01'), (null, 'b', timestamp '2024-01-02'), "
                   "(2d, null, timestamp '2024-01-03'), (3d, 'c', null) t(v, s, ts)")
    assert Imputer("drop", "drop").fit_transform(df).count() == 1
    assert Imputer("drop", "drop", exclude=("v", "s", "ts")).fit_transform(df).count() == 3   # datetimes are not excluded
    assert Imputer("mean", "constant", "ffill", order_by=("v",)).fit(df).dt_strategy == "ffill"


@pytest.mark.parametrize("bad", [
    {"num_strategy": "constant"}, {"cat_strategy": "mean"}, {"dt_strategy": "mode"}, {"num_strategy": "ffill"},
])
def test_bad_strategies(bad):
    with pytest.raises(ValueError):
        Imputer(**bad)


# ---- outliers ----

def test_bounds_match_pandas(spark):
    df, pdf = frame(spark)
    got = bounds(df, "iqr", ["k"])
    for c in ("flat", "wide", "tail"):
        q1, q3 = pdf[c].quantile([0.25, 0.75])
        assert got[c] == pytest.approx((q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)))
    got = bounds(df, "zscore", ["k"])
    mean, std = pdf["tail"].mean(), pdf["tail"].std()
    assert got["tail"] == pytest.approx((mean - 3 * std, mean + 3 * std))


def test_drop_clip_and_report(spark):
    df = spark.createDataFrame([(float(i),) for i in range(20)] + [(500.0,), (None,)], "v double")
    limits = bounds(df)
    assert drop_outside(df, limits).count() == 20           # the null goes with the outlier
    clipped = clip_to(df, limits)
    assert clipped.count() == 22 and clipped.where("v is null").count() == 1
    assert clipped.agg(F.max("v")).first()[0] == limits["v"][1]
    assert count_outside(df, limits) == 1
    row = outlier_report(df).first()
    assert (row["rows"], row["rows_removed"], row["values_clipped"]) == (22, 2, 1)
    assert row["percent_removed"] == pytest.approx(100 * 2 / 22)


def test_outlier_edges(spark):
    nulls = spark.createDataFrame([(None, 1.0)], "v double, w double")
    assert handle_outliers(nulls).count() == 0
    assert handle_outliers(nulls, strategy="clip").count() == 1
    assert bounds(nulls, "zscore")["w"] == (None, None)
    empty = spark.createDataFrame([], "v double")
    assert outlier_report(empty).first()["percent_removed"] is None
    for bad in ({"method": "magic"}, {"strategy": "isolation_forest"}):
        with pytest.raises(ValueError):
            handle_outliers(nulls, **bad)
    with pytest.raises(NotImplementedError):
        handle_outliers(nulls, "isolation_forest", "clip")


def test_isolation_forest(spark):
    rng = np.random.default_rng(0)
    points = [(int(i), float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(3000, 2)))]
    planted = [(9000 + i, 40.0 + i, -40.0) for i in range(5)]
    df = spark.createDataFrame(points + planted, "id int, a double, b double")
    kept = IsolationForest().fit(df, ["a", "b"]).keep_inliers(df)
    ids = {r[0] for r in kept.select("id").collect()}
    assert len(ids) == pytest.approx(0.9 * 3005, abs=3)
    assert not ids & {p[0] for p in planted}
    again = IsolationForest().fit(df.repartition(17), ["a", "b"]).keep_inliers(df.repartition(3))
    assert {r[0] for r in again.select("id").collect()} == ids


def test_isolation_forest_large_pool_and_edges(spark):
    df = spark.range(3000).select(F.col("id").cast("double").alias("a"))
    model = IsolationForest(trees=10, sample_rows=64).fit(df, ["a"])
    assert model.nodes["tree"].nunique() == 10
    assert model.outlier_flags(df).where("outlier").count() == pytest.approx(300, abs=60)
    with pytest.raises(ValueError):
        IsolationForest().fit(spark.createDataFrame([(None,)], "a double"), ["a"])
    with pytest.raises(ValueError):
        IsolationForest().fit(spark.createDataFrame([], "a double"), ["a"])
    same = spark.createDataFrame([(1.0,)] * 10, "a double")
    assert handle_outliers(same, "isolation_forest").count() == 10


# ---- encode ----

@pytest.mark.parametrize("window_values", [1_000_000, 1])
def test_label_encoder(spark, window_values):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("c", "x"), (None, "y"), ("a", "é")], "s string, t string")
    model = LabelEncoder(window_values=window_values).fit(df)
    assert values(model.transform(df)) == [(0, 2), (0, 3), (1, 0), (2, 0), (3, 1)]
    new = spark.createDataFrame([("zz", "x")], "s string, t string")
    with pytest.raises(Exception, match="not seen"):
        model.transform(new).collect()
    assert values(LabelEncoder(unseen="null").fit(df).transform(new)) == [(None, 0)]


def test_label_encoder_through_a_shuffled_lookup(spark, monkeypatch):
    import tabprep.operators.lookup as lk
    monkeypatch.setattr(lk, "BROADCAST_ROWS", 0)
    df = spark.range(200).selectExpr("id", "if(id % 3 = 0, 'hot', concat('v', id % 7)) as s")
    model = LabelEncoder().fit(df)
    object.__setattr__(model, "heavy", {"s": ["hot"]})
    got = model.transform(df)
    assert got.count() == 200
    codes = {v: i for i, v in enumerate(sorted({r["s"] for r in df.collect()}))}
    assert values(got) == sorted((r["id"], codes[r["s"]]) for r in df.collect())


def test_onehot(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("c", 4)], "s string, v int")
    got = OneHotEncoder().fit_transform(df)
    assert got.columns == ["v", "s_b", "s_c"]
    assert values(got) == [(1, True, False), (2, False, False), (3, False, False), (4, False, True)]
    assert ColumnRoles.of(got).numeric == ("v",)
    with pytest.raises(ValueError):
        OneHotEncoder(max_dummies=2).fit(df)
    with pytest.raises(ValueError):
        encode_categorical(df, "hash")
    assert dict(encode_categorical(df, "label").dtypes)["s"] == "int"


# ---- scale ----

def test_scalers(spark):
    df, pdf = frame(spark)
    for parts in (1, 17):
        got = Scaler("standard", ["k"]).fit_transform(df.repartition(parts)).agg(
            F.avg("wide"), F.stddev_pop("wide"), F.count("tail")).first()
        assert got[0] == pytest.approx(0, abs=1e-12) and got[1] == pytest.approx(1)
        assert got[2] == pdf["tail"].count()
    got = Scaler("minmax", ["k"]).fit_transform(df).agg(F.min("tail"), F.max("tail")).first()
    assert tuple(got) == (0.0, 1.0)


def test_scaler_edges(spark):
    df = spark.createDataFrame([(5.0, None, 1), (5.0, None, 3)], "c double, n double, i int")
    for kind, ints in (("standard", [-1.0, 1.0]), ("minmax", [0.0, 1.0])):
        got = Scaler(kind).fit_transform(df).collect()
        assert [r["c"] for r in got] == [0.0, 0.0] and [r["n"] for r in got] == [None, None]
        assert [r["i"] for r in got] == ints
    model = Scaler("minmax").fit(df)
    assert model.transform(spark.createDataFrame([(9,)], "i int")).first()[0] == 4.0      # unseen data may leave [0, 1]
    assert model.transform(df, exclude=["i"]).first()["i"] == 1
    with pytest.raises(ValueError):
        Scaler("robust")


# ---- split ----

def test_splits(spark):
    df = spark.range(1000)
    train, test = split_hash(df, ["id"])
    assert train.count() + test.count() == 1000 and train.intersect(test).count() == 0
    assert values(split_hash(df.repartition(17), ["id"])[1]) == values(test)
    train, test = split_exact(df, ["id"], 0.2001)
    assert (test.count(), train.count()) == (201, 799) and train.intersect(test).count() == 0
    assert values(split_exact(df.repartition(9), ["id"], 0.2001)[1]) == values(test)
    assert values(split_hash(df, ["id"], seed=1)[1]) != values(split_hash(df, ["id"])[1])
    with pytest.raises(ValueError):
        split_hash(df, ["id"], 1.0)


def test_exact_split_with_ties(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id")
    train, test = split_exact(df, ["k"], 0.5)
    assert (train.count(), test.count()) == (50, 50) and train.intersect(test).count() == 0


def test_folds(spark):
    got = assign_folds(spark.range(1000), ["id"]).groupBy("fold").count().collect()
    assert {r["fold"] for r in got} == set(range(5)) and sum(r["count"] for r in got) == 1000
    with pytest.raises(ValueError):
        assign_folds(spark.range(3), ["id"], 1)


def test_null_keys_are_not_cut_by_their_text(spark):
    """Rows whose text key is null went through a cut, two scans of the table, for every five bytes of the longest text."""
    df = spark.range(400).selectExpr("id", "if(id = 7, repeat('x', 40), null) as code", "if(id % 5 = 0, id, null) as v")
    kinds = [cut.part.kind for cut in OrderedBuckets.fit(df, ["code", "id"], 20).cuts]
    assert kinds[0] == "null" and "text" not in kinds and len(kinds) <= 4
    found = {r["id"]: r["v"] for r in fill(df, ["v"], ["code", "id"], rows_per_bucket=20).collect()}
    assert found == {i: 395 if i == 7 else i - i % 5 for i in range(400)}
