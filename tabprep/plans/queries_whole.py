"""Registered queries over all columns and roles at once: flows, fills, encodings fitted apart, full explorations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.operators.encode import LabelEncoder, OneHotEncoder
from tabprep.operators.impute import Imputer
from tabprep.operators.ordered import fill
from tabprep.operators.quantiles import exact_quantiles
from tabprep.operators.regress import cross_validate_linear, mean_score
from tabprep.operators.split import assign_folds, split_exact, split_hash
from tabprep.plans.explore import explore_long
from tabprep.plans.queries_analyse import (
    CUT, FOLD_SQL, LABEL, LINE_KEY, PROFILE_EXPRS, PROFILE_SQL, _explore_long_sql, _kendall_sql, _spearman_sql,
)
from tabprep.plans.queries_prepare import AHEAD, BACK
from tabprep.plans.registry import (
    DIRTY_CUSTOMER_SPARK, DIRTY_CUSTOMER_SQL, DIRTY_LINEITEM, DIRTY_LINEITEM_SQL, GAPPY_EVENTS, GAPPY_EVENTS_SQL, hash_sql,
    query, rounded, table, view,
)
from tabprep.plans.training import RegressionFlow

FEATURES = ("quantity", "discount", "l_tax")


# ---- least squares on three features, as SQL ----

def _moments(x):
    """The moments that the normal equations of three features need."""
    a = [f"covar_pop({x[i]}, {x[j]}) as a{i}{j}" for i in range(3) for j in range(i, 3)]
    b = [f"covar_pop(y, {c}) as b{i}" for i, c in enumerate(x)]
    return ", ".join([*a, *b, "avg(y) as my", *[f"avg({c}) as m{i}" for i, c in enumerate(x)]])


def _solved(source, keep=""):
    """Coefficients by Cramer's rule."""
    cell = lambda i, j: f"a{min(i, j)}{max(i, j)}"

    def determinant(swap=None):
        def at(i, j):
            return f"b{i}" if j == swap else cell(i, j)
        return "(" + " + ".join(
            f"{at(0, j)} * ({at(1, (j + 1) % 3)} * {at(2, (j + 2) % 3)} - {at(1, (j + 2) % 3)} * {at(2, (j + 1) % 3)})" for j in range(3)) + ")"

    betas = ", ".join(f"{determinant(j)} / {determinant()} as c{j}" for j in range(3))
    return f"(select *, my - c0 * m0 - c1 * m1 - c2 * m2 as c from (select {keep}my, m0, m1, m2, {betas} from {source}))"


def _flow_sql():
    source = f"(select *, {hash_sql(*LINE_KEY)} >= {CUT} as train from {DIRTY_LINEITEM_SQL}) s"
    middle = ", ".join(f"quantile_cont(abs({c}), 0.5) as med_{c}" for c in FEATURES)
    filled = ", ".join(f"coalesce(abs({c}), med_{c}) as {c}" for c in FEATURES)
    edges = ", ".join(f"quantile_cont({c}, 0.25) as lo_{c}, quantile_cont({c}, 0.75) as hi_{c}" for c in FEATURES)
    inside = " and ".join(f"{c} between lo_{c} - 1.5 * (hi_{c} - lo_{c}) and hi_{c} + 1.5 * (hi_{c} - lo_{c})" for c in FEATURES)
    predicted = "c + " + " + ".join(f"c{i} * {c}" for i, c in enumerate(FEATURES))
    return f"""
    with med as (select {middle} from {source} where train),
         filled as (select train, {filled}, abs({LABEL}) as y from {source}, med),
         edges as (select {edges} from filled where train),
         kept as (select {', '.join(FEATURES)}, y from filled, edges where train and {inside}),
         fit as (select * from {_solved(f"(select {_moments(FEATURES)} from kept)")}),
         scored as (select y, {predicted} as p from filled, fit where not train)
    select (select count(*) from kept) as n_train, count(*) as n_test, round(avg((y - p) ** 2), 1) as mse,
           round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 8) as r2, round(avg(abs(y - p)), 5) as mae
    from scored"""


@query("train_score_linreg_all", _flow_sql())
def train_score_all(spark, sf_dir):
    """The flow with every column but the key as a feature, nulls in two of them."""
    found = RegressionFlow(LABEL, LINE_KEY).run(view(spark, sf_dir, "lineitem", DIRTY_LINEITEM))
    return rounded(found, {"mse": 1, "r2": 8, "mae": 5})


RAW = ("l_quantity", "l_discount", "l_tax")


def _cv_sql():
    source = f"""(select k.fold as out, {_moments(RAW)} from f join (select distinct fold from f) k on f.fold <> k.fold
                 group by k.fold)"""
    predicted = "c + " + " + ".join(f"c{i} * {c}" for i, c in enumerate(RAW))
    return f"""
    with f as (select {FOLD_SQL} as fold, {', '.join(RAW)}, {LABEL} as y from lineitem),
         m as (select * from {_solved(source, "out, ")})
    select count(*) as folds, round(avg(mse), 2) as mean_mse from (
        select f.fold, avg((y - ({predicted})) ** 2) as mse from f join m on f.fold = m.out group by f.fold)"""


@query("cv_score_all", _cv_sql())
def cv_score_all(spark, sf_dir):
    lines = assign_folds(table(spark, sf_dir, "lineitem"), LINE_KEY)
    return rounded(mean_score(cross_validate_linear(lines, LABEL, list(RAW), "fold")), {"mean_mse": 2})


# ---- fills through the imputer, and by keys of other types ----

def _all_roles_sql(function, frame):
    cells = ", ".join(f"{function}({c} ignore nulls) over (order by event_id {frame}) as {c}" for c in ("value", "event_type", "seen"))
    return f"select event_id, user_id, ts, {cells} from {GAPPY_EVENTS_SQL}"


def _all_roles(spark, sf_dir, strategy):
    imputer = Imputer(strategy, strategy, strategy, exclude=("user_id",), order_by=("event_id",), rows_per_bucket=2_000)
    return imputer.fit_transform(view(spark, sf_dir, "events", GAPPY_EVENTS))


@query("impute_ffill_all_roles", _all_roles_sql("last_value", BACK))
def impute_ffill(spark, sf_dir):
    return _all_roles(spark, sf_dir, "ffill")


@query("impute_bfill_all_roles", _all_roles_sql("first_value", AHEAD))
def impute_bfill(spark, sf_dir):
    return _all_roles(spark, sf_dir, "bfill")


TEXT_KEY = ["event_id", "'k' || (event_id % 3) as hot", "if(event_id % 10 = 7, null, md5('' || event_id)) as code",
            "case when event_id % 4 = 1 then value end as value"]
TEXT_KEY_SQL = f"(select {', '.join(TEXT_KEY).replace('if(event_id % 10 = 7, null, ', 'if(event_id % 10 = 7, null::varchar, ')} from events) t"


@query("ffill_text_keys", f"""
    select event_id, hot, code, last_value(value ignore nulls) over (order by hot, code nulls first, event_id {BACK}) as value
    from {TEXT_KEY_SQL}""")
def ffill_text_keys(spark, sf_dir):
    """The first key is a text with three values, the second has nulls."""
    return fill(view(spark, sf_dir, "events", TEXT_KEY), ["value"], ["hot", "code", "event_id"], rows_per_bucket=500)


# ---- encodings fitted on one part and applied to the other ----

SPLIT_SQL = f"(select *, {hash_sql('c_custkey')} >= {CUT} as train from {DIRTY_CUSTOMER_SQL})"
SEGMENT_VALUES = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("label_fit_apply", f"""
    with s as {SPLIT_SQL},
         codes as (select segment, row_number() over (order by segment) - 1 as code from s where train and segment is not null group by segment)
    select c_custkey, c_acctbal, cast(coalesce(code, (select count(*) from codes)) as int) as segment
    from s left join codes on s.segment = codes.segment where not train""")
def label_fit_apply(spark, sf_dir):
    train, test = split_hash(view(spark, sf_dir, "customer", DIRTY_CUSTOMER_SPARK).drop("nation"), ["c_custkey"])
    return LabelEncoder(["segment"]).fit(train).transform(test)


@query("onehot_fit_apply", f"""
    select c_custkey, c_acctbal, {', '.join(f"coalesce(segment = '{v}', false) as segment_{v}" for v in SEGMENT_VALUES)}
    from {SPLIT_SQL} where not train""")
def onehot_fit_apply(spark, sf_dir):
    train, test = split_hash(view(spark, sf_dir, "customer", DIRTY_CUSTOMER_SPARK).drop("nation"), ["c_custkey"])
    return OneHotEncoder(["segment"]).fit(train).transform(test)


# ---- exact numbers on hard tables ----

@query("split_exact_ties", "select cast(ceil(0.2 * count(*)) as bigint) as test, cast(count(*) - ceil(0.2 * count(*)) as bigint) as train from orders")
def split_exact_ties(spark, sf_dir):
    """The key is one of three values, and many rows are equal."""
    rows = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority")
    train, test = split_exact(rows, ["o_orderstatus"])
    count = F.count("*")
    return test.agg(count.alias("test")).crossJoin(train.agg(count.alias("train")))            # one row each


QUANTILE_COLUMNS = {
    "l_extendedprice": "l_extendedprice", "signed": "(l_extendedprice - 45000) * (l_linenumber - 3) + 0.0", "close": "1.0 + l_quantity / 1e15",
    "sized": "l_discount * power(10.0, l_linenumber * 9)", "l_quantity": "l_quantity", "l_tax": "l_tax"}
QUANTILE_PROBS = (0.01, 0.25, 0.5, 0.75, 0.99)


@query("quantiles_many", " union all ".join(
    f"""select '{name}' as "column", {p}::double as p, printf('%.9e', quantile_cont(v, {p})) as value
        from (select ({expr})::double as v from lineitem)""" for name, expr in QUANTILE_COLUMNS.items() for p in QUANTILE_PROBS))
def quantiles_many(spark, sf_dir):
    """Six columns, among them some of both signs, of sizes far apart, and of values that share most of their bits."""
    lines = table(spark, sf_dir, "lineitem").select(*[F.expr(e).cast("double").alias(n) for n, e in QUANTILE_COLUMNS.items()])
    found = exact_quantiles(lines, list(QUANTILE_COLUMNS), QUANTILE_PROBS)
    rows = [(c, p, f"{v:.9e}") for c, values in found.items() for p, v in values.items()]
    return spark.createDataFrame(rows, "column string, p double, value string")


# ---- the full look with rank correlations ----

def _explore_sql(correlations):
    kept = _explore_long_sql()
    return f"select * from ({kept}) where section <> 'correlation' union all " + \
        f"""select 'correlation' as section, col_a as "column", col_b as metric, round(corr, 6) as value from ({correlations})"""


def _explore(spark, sf_dir, method):
    return rounded(explore_long(view(spark, sf_dir, "customer", PROFILE_EXPRS), method), 6)


@query("explore_long_spearman", _explore_sql(_spearman_sql(PROFILE_SQL, ["c_acctbal", "priority"])))
def explore_spearman(spark, sf_dir):
    return _explore(spark, sf_dir, "spearman")


@query("explore_long_kendall", _explore_sql(_kendall_sql(PROFILE_SQL, ["c_acctbal", "priority"])))
def explore_kendall(spark, sf_dir):
    return _explore(spark, sf_dir, "kendall")
