"""Registered queries: profiles, correlations, distributions, splits, regression and tuning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.operators.corr import correlation
from tabprep.operators.distribution import box_fliers, box_stats, histogram, kde
from tabprep.operators.profile import (
    describe, describe_datetimes, distinct_rows, duplicate_count, missing_table, profile_long, skewness,
    skewness_by_size, table_info, top_values,
)
from tabprep.operators.regress import (
    ForestParams, assemble, cross_validate_linear, fit_forest, fit_linear, mean_score, regression_metrics,
)
from tabprep.operators.split import assign_folds, fold_sizes, split_exact, split_hash
from tabprep.operators.tune import Space, median_prune, refit_best, search_forest
from tabprep.plans.explore import explore_long
from tabprep.plans.registry import (
    DIRTY_CUSTOMER_SPARK, DIRTY_CUSTOMER_SQL, DIRTY_LINEITEM, DIRTY_LINEITEM_SQL, hash_sql, query, rounded, bagged, table,
    view,
)
from tabprep.plans.training import RegressionFlow

MEASURES = ("quantity", "discount", "l_tax", "l_extendedprice")
MEASURES_SQL = f"(select {', '.join(MEASURES)} from {DIRTY_LINEITEM_SQL}) m"


def _measures(spark, sf_dir):
    return view(spark, sf_dir, "lineitem", DIRTY_LINEITEM).select(*MEASURES)


# ---- profile ----

INFO_TYPES = {"c_custkey": "bigint", "c_acctbal": "double", "segment": "string", "nation": "string"}


def _info_sql(source, types):
    return " union all ".join(
        f"select '{c}' as \"column\", '{t}' as type, count({c}) as non_null, count(*) as rows from {source}"
        for c, t in types.items())


@query("table_info", _info_sql(DIRTY_CUSTOMER_SQL, INFO_TYPES))
def info(spark, sf_dir):
    return table_info(view(spark, sf_dir, "customer", DIRTY_CUSTOMER_SPARK))


def _describe_sql(source, cols):
    return " union all ".join(
        f"""select '{c}' as "column", count({c}) as count, round(avg({c}), 8) as mean,
            round(stddev_samp({c}), 8) as std, cast(min({c}) as double) as min,
            round(quantile_cont({c}, 0.25), 8) as q25, round(quantile_cont({c}, 0.5), 8) as q50,
            round(quantile_cont({c}, 0.75), 8) as q75, cast(max({c}) as double) as max from {source}"""
        for c in cols)


@query("describe", _describe_sql(MEASURES_SQL, MEASURES))
def describe_measures(spark, sf_dir):
    return rounded(describe(_measures(spark, sf_dir)), 8, ["mean", "std", "q25", "q50", "q75"])


@query("describe_datetimes", """
    select 'o_orderdate' as "column", count(o_orderdate) as count,
           make_timestamp(cast(round(avg(epoch_us(o_orderdate))) as bigint)) as mean, min(o_orderdate) as min,
           make_timestamp(cast(round(quantile_cont(cast(epoch_us(o_orderdate) as double), 0.25)) as bigint)) as q25,
           make_timestamp(cast(round(quantile_cont(cast(epoch_us(o_orderdate) as double), 0.5)) as bigint)) as q50,
           make_timestamp(cast(round(quantile_cont(cast(epoch_us(o_orderdate) as double), 0.75)) as bigint)) as q75,
           max(o_orderdate) as max
    from orders""")
def describe_dates(spark, sf_dir):
    return describe_datetimes(table(spark, sf_dir, "orders"))


def _missing_sql(source, cols):
    return " union all ".join(
        f"""select '{c}' as "column", count(*) - count({c}) as missing_count,
            round(100.0 * (count(*) - count({c})) / count(*), 8) as missing_percent from {source}
            having count(*) > count({c})""" for c in cols)


@query("missing_table", _missing_sql(DIRTY_CUSTOMER_SQL, INFO_TYPES))
def missing(spark, sf_dir):
    return rounded(missing_table(view(spark, sf_dir, "customer", DIRTY_CUSTOMER_SPARK)), 8)


DUP_ORDERS = ("o_custkey", "o_orderstatus", "o_orderpriority")


@query("duplicate_count", f"""
    select (select count(*) from orders)
           - (select count(*) from (select distinct {', '.join(DUP_ORDERS)} from orders)) as duplicates""")
def duplicates(spark, sf_dir):
    return duplicate_count(table(spark, sf_dir, "orders").select(*DUP_ORDERS))


@query("distinct_rows", f"select distinct {', '.join(DUP_ORDERS)} from orders")
def distinct(spark, sf_dir):
    return distinct_rows(table(spark, sf_dir, "orders").select(*DUP_ORDERS))


def _top_sql(source, cols):
    counted = " union all ".join(
        f"""select '{c}' as "column", cast({c} as varchar) as value, count(*) as n from {source}
            where {c} is not null group by 1, 2""" for c in cols)
    return f"""select * from (select *, cast(row_number() over (partition by "column" order by n desc, value) as int)
               as rank from ({counted})) where rank <= 5"""


TOP_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus", "l_shipdate")


@query("top_values", _top_sql("lineitem", TOP_COLUMNS))
def top(spark, sf_dir):
    return top_values(table(spark, sf_dir, "lineitem"), 5, TOP_COLUMNS)


SKEWED = ("n_chars", "steady", "length_rank")
SKEWED_EXPRS = ["n_chars", "cast(1 as double) as steady", "doc_id * doc_id as length_rank"]
SKEWED_SQL = f"(select {', '.join(SKEWED_EXPRS)} from documents) d"


def _skew_sql(source, cols, constant=()):
    """DuckDB gives null for a constant column where the wanted value is 0."""
    parts = []
    for c in cols:
        value = "case when count({c}) >= 3 then 0.0::double end" if c in constant else "skewness({c})"
        parts.append(f"select '{c}' as \"column\", round({value.format(c=c)}, 7) as skewness from {source}")
    inner = " union all ".join(parts)
    return f"""select "column", skewness, case when abs(skewness) > 1 then 'high' when abs(skewness) > 0.5
               then 'moderate' when abs(skewness) <= 0.5 then 'symmetric' end as class from ({inner})"""


@query("skewness", _skew_sql(SKEWED_SQL, SKEWED, ("steady",)))
def skew(spark, sf_dir):
    return rounded(skewness(view(spark, sf_dir, "documents", SKEWED_EXPRS)), 7)


@query("skewness_class", _skew_sql(SKEWED_SQL, SKEWED, ("steady",)) + ' order by abs(skewness), "column"')
def skew_class(spark, sf_dir):
    return rounded(skewness_by_size(view(spark, sf_dir, "documents", SKEWED_EXPRS)), 7)


def _long_sql(section, inner, metrics, name='"column"'):
    return " union all ".join(
        f"""select '{section}' as section, {name} as "column", '{m}' as metric, round(cast({m} as double), 6) as value
            from ({inner})""" for m in metrics)


def _profile_long_sql(source, cols, types, constant=()):
    numeric = [c for c in cols if types[c] not in ("string",)]
    return " union all ".join([
        _long_sql("info", _info_sql(source, types), ["non_null", "rows"]),
        _long_sql("describe", _describe_sql(source, numeric), ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]),
        _long_sql("missing", _missing_sql(source, cols), ["missing_count", "missing_percent"]),
        _long_sql("skewness", _skew_sql(source, numeric, constant), ["skewness"]),
        _long_sql("duplicates", f"""select cast(null as varchar) as "column", (select count(*) from {source})
            - (select count(*) from (select distinct * from {source})) as duplicates""", ["duplicates"]),
        f"""select 'top_values' as section, "column", value as metric, cast(n as double) as value
            from ({_top_sql(source, cols)})""",
    ])


PROFILE_TYPES = {"c_acctbal": "double", "segment": "string", "nation": "string", "priority": "double"}
PROFILE_EXPRS = [*DIRTY_CUSTOMER_SPARK[1:], "cast(c_custkey % 7 as double) as priority"]
PROFILE_SQL = f"""(select c_acctbal, segment, nation, cast(c_custkey % 7 as double) as priority
                  from {DIRTY_CUSTOMER_SQL}) p"""


@query("profile_long", _profile_long_sql(PROFILE_SQL, list(PROFILE_TYPES), PROFILE_TYPES))
def profile_table(spark, sf_dir):
    return rounded(profile_long(view(spark, sf_dir, "customer", PROFILE_EXPRS)), 6)


# ---- correlation ----

def _both(a, b):
    return f"from {{source}} where {a} is not null and {b} is not null"


def _pearson_sql(source, cols, digits=8):
    cells = []
    for a in cols:
        for b in cols:
            cells.append(f"""select '{a}' as col_a, '{b}' as col_b, round(covar_pop({a}, {b})
                / nullif(stddev_pop({a}) * stddev_pop({b}), 0), {digits}) as corr
                {_both(a, b).format(source=source)}""")
    return " union all ".join(cells)


CORR_COLUMNS = (*MEASURES, "one")
CORR_SQL = f"(select {', '.join(MEASURES)}, cast(1 as double) as one from {DIRTY_LINEITEM_SQL}) c"


@query("corr_pearson", _pearson_sql(CORR_SQL, CORR_COLUMNS))
def corr_pearson(spark, sf_dir):
    return rounded(correlation(_measures(spark, sf_dir).withColumn("one", F.lit(1.0)), "pearson"), 8)


def _spearman_sql(source, cols):
    cells = []
    for a in cols:
        for b in cols:
            ranks = ", ".join(
                f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0 as {n}"
                for c, n in ((a, "ra"), (b, "rb")))
            cells.append(f"""select '{a}' as col_a, '{b}' as col_b, round(covar_pop(ra, rb)
                / nullif(stddev_pop(ra) * stddev_pop(rb), 0), 8) as corr
                from (select {ranks} {_both(a, b).format(source=source)})""")
    return " union all ".join(cells)


@query("corr_spearman", _spearman_sql(MEASURES_SQL, MEASURES))
def corr_spearman(spark, sf_dir):
    return rounded(correlation(_measures(spark, sf_dir), "spearman"), 8)


PART_COLUMNS = ("p_size", "price", "p_retailprice")
PART_EXPRS = ["p_size", "case when p_partkey % 6 <> 0 then p_retailprice - p_size end as price", "p_retailprice"]
PART_SQL = f"(select {', '.join(PART_EXPRS)} from part) k"


def _kendall_sql(source, cols):
    cells = []
    for a in cols:
        for b in cols:
            if a == b:
                cells.append(f"select '{a}' as col_a, '{b}' as col_b, 1.0::double as corr")
                continue
            rows = f"(select {a} as x, {b} as y, count(*) as n {_both(a, b).format(source=source)} group by 1, 2)"
            cells.append(f"""select '{a}' as col_a, '{b}' as col_b,
                round((select sum(l.n * r.n * sign(r.y - l.y)) from {rows} l join {rows} r on l.x < r.x)
                / sqrt(((select sum(n) * (sum(n) - 1) / 2 from {rows})
                        - (select sum(n * (n - 1) / 2) from (select sum(n) as n from {rows} group by x)))
                     * ((select sum(n) * (sum(n) - 1) / 2 from {rows})
                        - (select sum(n * (n - 1) / 2) from (select sum(n) as n from {rows} group by y)))), 10) as corr""")
    return " union all ".join(cells)


@query("corr_kendall", _kendall_sql(PART_SQL, PART_COLUMNS))
def corr_kendall(spark, sf_dir):
    return rounded(correlation(view(spark, sf_dir, "part", PART_EXPRS), "kendall"), 10)


# ---- distributions ----

def _histogram_sql(source, cols, bins=30):
    cells = []
    for c in cols:
        cells.append(f"""
            select '{c}' as "column", cast(g.bin as int) as bin, round(lo + g.bin * w, 8) as low,
                   round(case when g.bin = {bins - 1} then hi else lo + (g.bin + 1) * w end, 8) as high,
                   coalesce(n, 0) as count, round(coalesce(n, 0) / (total * w), 10) as density
            from (select min({c}) as lo, max({c}) as hi, (max({c}) - min({c})) / {bins} as w, count({c}) as total
                  from {source}) e
            cross join (select unnest(range({bins})) as bin) g
            left join (
                select case when x < lo + guess * w then guess - 1
                            when guess < {bins - 1} and x >= lo + (guess + 1) * w then guess + 1
                            else guess end as bin, count(*) as n
                from (select {c} as x, lo, w, least(floor(({c} - lo) / w), {bins - 1}) as guess
                      from {source}, (select min({c}) as lo, (max({c}) - min({c})) / {bins} as w from {source})
                      where {c} is not null) group by 1) h on h.bin = g.bin""")
    return " union all ".join(cells)


@query("histogram", _histogram_sql(MEASURES_SQL, MEASURES))
def histograms(spark, sf_dir):
    return rounded(histogram(_measures(spark, sf_dir)), {"low": 8, "high": 8, "density": 10})


def _kde_sql(source, cols, points=200, digits=9):
    return " union all ".join(f"""
        select '{c}' as "column", cast(i as int) as point, round(lo + i * step, 8) as x,
               round(sum(exp(-0.5 * ((lo + i * step - v) / h) ** 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), {digits})
               as density
        from (select min({c}) as lo, (max({c}) - min({c})) / {points - 1} as step,
                     stddev_samp({c}) * power(count({c}), -0.2) as h, count({c}) as n from {source}) e,
             (select unnest(range({points})) as i) g, (select {c} as v from {source} where {c} is not null) s
        group by i, lo, step""" for c in cols)


@query("kde", _kde_sql("events", ("value",)))
def density(spark, sf_dir):
    return rounded(kde(table(spark, sf_dir, "events"), ["value"]), {"x": 8, "density": 9})


BOX_EXPRS = ["n_chars", "doc_id"]
BOX_COLUMNS = ("n_chars", "doc_id")


def _box_sql(source, cols):
    return " union all ".join(f"""
        select '{c}' as "column", any_value(q1) as q25, any_value(q2) as median, any_value(q3) as q75,
               cast(min({c}) as double) as min,
               cast(min({c}) filter (where {c} between lo and hi) as double) as whisker_low,
               cast(max({c}) filter (where {c} between lo and hi) as double) as whisker_high,
               cast(max({c}) as double) as max, count(*) filter (where {c} < lo or {c} > hi) as outliers
        from {source}, (select q1, q2, q3, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from
            (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.5) as q2, quantile_cont({c}, 0.75) as q3
             from {source}))""" for c in cols)


@query("box_stats", _box_sql("documents", BOX_COLUMNS))
def boxes(spark, sf_dir):
    return box_stats(table(spark, sf_dir, "documents"), BOX_COLUMNS)


@query("box_fliers", " union all ".join(f"""
    select '{c}' as "column", cast({c} as double) as value
    from documents, (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3 from documents)
    where {c} < q1 - 1.5 * (q3 - q1) or {c} > q3 + 1.5 * (q3 - q1)""" for c in BOX_COLUMNS))
def fliers(spark, sf_dir):
    return box_fliers(table(spark, sf_dir, "documents"), BOX_COLUMNS)


def _explore_long_sql():
    numeric = ["c_acctbal", "priority"]
    bin_sql = f"select *, cast(bin as varchar) as name from ({_histogram_sql(PROFILE_SQL, numeric)})"
    kde_sql = f"select *, cast(point as varchar) as name from ({_kde_sql(PROFILE_SQL, numeric)})"
    return " union all ".join([
        _profile_long_sql(PROFILE_SQL, list(PROFILE_TYPES), PROFILE_TYPES),
        f"""select 'correlation' as section, col_a as "column", col_b as metric, round(corr, 6) as value
            from ({_pearson_sql(PROFILE_SQL, numeric)})""",
        f"""select 'histogram' as section, "column", name as metric, cast(count as double) as value from ({bin_sql})""",
        f"""select 'kde' as section, "column", name as metric, round(density, 6) as value from ({kde_sql})""",
        _long_sql("box_stats", _box_sql(PROFILE_SQL, numeric),
                  ["q25", "median", "q75", "min", "whisker_low", "whisker_high", "max", "outliers"]),
    ])


@query("explore_long", _explore_long_sql())
def explore_table(spark, sf_dir):
    return rounded(explore_long(view(spark, sf_dir, "customer", PROFILE_EXPRS)), 6)


# ---- splits ----

LINE_KEY = ("l_orderkey", "l_linenumber")
CUT = "floor(0.2 * 4503599627370496)"


@query("split_hash", f"""
    select l_orderkey, l_linenumber, l_quantity,
           case when {hash_sql(*LINE_KEY)} < {CUT} then 'test' else 'train' end as part from lineitem""")
def hash_split(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_quantity")
    train, test = split_hash(lines, LINE_KEY)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("split_exact", f"""
    select o_orderkey, o_totalprice,
           case when row_number() over (order by {hash_sql('o_orderkey')}) <= ceil(0.2 * count(*) over ())
           then 'test' else 'train' end as part from orders""")
def exact_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    train, test = split_exact(orders, ["o_orderkey"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("kfold_assign", f"select o_orderkey, cast({hash_sql('o_orderkey')} % 5 as int) as fold from orders")
def folds(spark, sf_dir):
    return assign_folds(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])


@query("kfold_sizes", f"""
    select cast({hash_sql(*LINE_KEY)} % 5 as int) as fold, count(*) as rows from lineitem group by 1""")
def sizes(spark, sf_dir):
    return fold_sizes(assign_folds(table(spark, sf_dir, "lineitem").select(*LINE_KEY), LINE_KEY))


# ---- regression ----

FEATURES = ["l_quantity", "l_discount"]
LABEL = "l_extendedprice"
TWO_FEATURES_SQL = """
    (select b1, b2, my - b1 * m1 - b2 * m2 as b0 from (
        select (c1y * c22 - c2y * c12) / (c11 * c22 - c12 * c12) as b1,
               (c2y * c11 - c1y * c12) / (c11 * c22 - c12 * c12) as b2, m1, m2, my
        from (select var_pop(l_quantity) as c11, var_pop(l_discount) as c22, covar_pop(l_quantity, l_discount) as c12,
                     covar_pop(l_quantity, l_extendedprice) as c1y, covar_pop(l_discount, l_extendedprice) as c2y,
                     avg(l_quantity) as m1, avg(l_discount) as m2, avg(l_extendedprice) as my from lineitem))) f"""


@query("linreg_fit", f"""
    select 'intercept' as term, round(b0, 4) as estimate from {TWO_FEATURES_SQL}
    union all select 'l_quantity', round(b1, 4) from {TWO_FEATURES_SQL}
    union all select 'l_discount', round(b2, 4) from {TWO_FEATURES_SQL}""")
def linreg_fit(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return rounded(fit_linear(lines, LABEL, FEATURES).table(lines), 4)


@query("linreg_predict", f"""
    select l_orderkey, l_linenumber, l_quantity, l_discount,
           round(b0 + b1 * l_quantity + b2 * l_discount, 2) as prediction from lineitem, {TWO_FEATURES_SQL}""")
def linreg_predict(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    scored = fit_linear(lines, LABEL, FEATURES).predict(lines.select("l_orderkey", "l_linenumber", *FEATURES))
    return rounded(scored, {"prediction": 2})


@query("reg_metrics", """
    select count(*) as rows, round(avg((y - p) * (y - p)), 2) as mse,
           round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 8) as r2, round(avg(abs(y - p)), 6) as mae
    from (select l_extendedprice as y, 2000 * l_quantity + 1000 as p from lineitem)""")
def reg_metrics(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("prediction", F.expr("2000 * l_quantity + 1000"))
    return rounded(regression_metrics(lines, LABEL), {"mse": 2, "r2": 8, "mae": 6})


FOLD_SQL = f"cast({hash_sql(*LINE_KEY)} % 5 as int)"


@query("cv_score", f"""
    with f as (select {FOLD_SQL} as fold, l_quantity as x, l_extendedprice as y from lineitem),
         m as (select k.fold, regr_slope(f.y, f.x) as b, regr_intercept(f.y, f.x) as a
               from f join (select distinct fold from f) k on f.fold <> k.fold group by k.fold)
    select count(*) as folds, round(avg(mse), 2) as mean_mse from (
        select f.fold, avg((y - a - b * x) ** 2) as mse from f join m on f.fold = m.fold group by f.fold)""")
def cv_score(spark, sf_dir):
    lines = assign_folds(table(spark, sf_dir, "lineitem"), LINE_KEY)
    return rounded(mean_score(cross_validate_linear(lines, LABEL, ["l_quantity"], "fold")), {"mean_mse": 2})


@query("cv_folds", f"""
    with f as (select {FOLD_SQL} as fold, l_quantity as x, l_extendedprice as y from lineitem),
         m as (select k.fold, regr_slope(f.y, f.x) as b, regr_intercept(f.y, f.x) as a
               from f join (select distinct fold from f) k on f.fold <> k.fold group by k.fold)
    select f.fold, count(*) as rows, round(avg((y - a - b * x) ** 2), 2) as mse,
           round(1 - sum((y - a - b * x) ** 2) / (var_pop(y) * count(*)), 8) as r2,
           round(avg(abs(y - a - b * x)), 6) as mae
    from f join m on f.fold = m.fold group by f.fold""")
def cv_folds(spark, sf_dir):
    lines = assign_folds(table(spark, sf_dir, "lineitem"), LINE_KEY)
    return rounded(cross_validate_linear(lines, LABEL, ["l_quantity"], "fold"), {"mse": 2, "r2": 8, "mae": 6})


FOREST_FEATURES = ["l_quantity", "l_discount", "l_tax"]


@query("rf_fit_predict")
def rf_fit_predict(spark, sf_dir):
    lines = bagged(table(spark, sf_dir, "lineitem").select(*LINE_KEY, *FOREST_FEATURES, LABEL), *LINE_KEY)
    train, test = split_hash(lines, LINE_KEY)
    model = fit_forest(assemble(train, FOREST_FEATURES, [LABEL]), LABEL, ForestParams(10, 5, 1, 1.0))
    scored = model.transform(assemble(test, FOREST_FEATURES, [*LINE_KEY, LABEL]))
    return scored.select(*LINE_KEY, LABEL, "prediction")


SMALL_SPACE = Space(trees=(2, 8, 2), max_depth=(2, 5), min_leaf=(1, 10), feature_share=(0.4, 1.0, 0.3))


def _search(spark, sf_dir):
    lines = bagged(table(spark, sf_dir, "lineitem").select(*LINE_KEY, *FOREST_FEATURES, LABEL), *LINE_KEY)
    return lines, search_forest(
        lines, LABEL, FOREST_FEATURES, LINE_KEY, trials=4, folds=3, parallelism=2, space=SMALL_SPACE, startup=2)


@query("tune_rf")
def tune_rf(spark, sf_dir):
    lines, search = _search(spark, sf_dir)
    return rounded(search.table(lines), {"mse": 2, "running_mean": 2})


@query("tune_best")
def tune_best(spark, sf_dir):
    lines, search = _search(spark, sf_dir)
    return refit_best(lines, LABEL, FOREST_FEATURES, search)[1]


@query("median_prune", f"""
    with mse as (
        select trial, fold + 1 as step, avg((y - 1000 * x - 5000 * ((trial * 7) % 12)) ** 2) as mse
        from (select {FOLD_SQL} as fold, l_quantity as x, l_extendedprice as y from lineitem),
             (select unnest(range(12)) as trial) group by 1, 2),
    running as (select trial, step, avg(mse) over (partition by trial order by step rows unbounded preceding)
                as running_mean from mse),
    best as (select *, min(running_mean) over (partition by trial order by step rows unbounded preceding) as best
             from running),
    peers as (select b.trial, b.step, b.running_mean, b.best, count(e.trial) as peers,
                     quantile_cont(e.running_mean, 0.5) as peer_median
              from best b left join best e on e.step = b.step and e.trial < b.trial group by all)
    select cast(trial as int) as trial, cast(step as int) as step, round(running_mean, 2) as running_mean,
           round(best, 2) as best, peers, round(peer_median, 2) as peer_median,
           peers >= 5 and coalesce(best > peer_median, false) as prune
    from peers""")
def prune(spark, sf_dir):
    lines = assign_folds(table(spark, sf_dir, "lineitem"), LINE_KEY)
    trials = lines.select("fold", "l_quantity", LABEL, F.explode(F.sequence(F.lit(0), F.lit(11))).alias("trial"))
    scored = trials.withColumn("error", F.expr("l_extendedprice - 1000 * l_quantity - 5000 * ((trial * 7) % 12)"))
    mse = scored.groupBy("trial", (F.col("fold") + 1).alias("step")).agg(
        F.avg(F.col("error") * F.col("error")).alias("mse"))
    reports = mse.selectExpr(
        "trial", "step", "avg(mse) over (partition by trial order by step rows unbounded preceding) as running_mean")
    return rounded(median_prune(reports), 2)


# ---- the whole flow ----

FLOW_EXPRS = ["l_orderkey", "l_linenumber", "case when l_partkey % 11 = 0 then null else l_quantity end as quantity",
              "l_extendedprice"]
FLOW_SQL = f"(select {', '.join(FLOW_EXPRS)} from lineitem) t"


def _flow_sql(cut_outliers):
    keep = ", (select quantile_cont(q, 0.25) as q1, quantile_cont(q, 0.75) as q3 from filled) where q between " \
           "q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)" if cut_outliers else ""
    return f"""
    with train as (select * from {FLOW_SQL} where {hash_sql(*LINE_KEY)} >= {CUT}),
         test as (select * from {FLOW_SQL} where {hash_sql(*LINE_KEY)} < {CUT}),
         med as (select quantile_cont(abs(quantity), 0.5) as med from train),
         filled as (select coalesce(abs(quantity), med) as q, abs(l_extendedprice) as y from train, med),
         kept as (select q, y from filled{keep}),
         sc as (select avg(q) as mean, coalesce(nullif(stddev_pop(q), 0), 1) as sd from kept),
         fit as (select regr_slope(y, (q - mean) / sd) as b, regr_intercept(y, (q - mean) / sd) as a from kept, sc),
         scored as (select abs(l_extendedprice) as y, a + b * (coalesce(abs(quantity), med) - mean) / sd as p
                    from test, med, sc, fit)
    select (select count(*) from kept) as n_train, count(*) as n_test, round(avg((y - p) ** 2), 1) as mse,
           round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 8) as r2, round(avg(abs(y - p)), 5) as mae
    from scored"""


def _flow(spark, sf_dir, method):
    flow = RegressionFlow(LABEL, LINE_KEY, outlier_method=method)
    return rounded(flow.run(view(spark, sf_dir, "lineitem", FLOW_EXPRS)), {"mse": 1, "r2": 8, "mae": 5})


@query("train_score_linreg", _flow_sql(True))
def train_score(spark, sf_dir):
    return _flow(spark, sf_dir, "iqr")


@query("train_score_linreg_uncut", _flow_sql(False))
def train_score_uncut(spark, sf_dir):
    return _flow(spark, sf_dir, None)
