"""Registered queries: sources, names, coercions, missing values, outliers, encoding and scaling."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabprep.functions.names import standardize_names, unique_names
from tabprep.operators.encode import LabelEncoder, OneHotEncoder
from tabprep.operators.impute import Imputer
from tabprep.operators.iforest import IsolationForest
from tabprep.operators.ordered import fill
from tabprep.operators.outliers import (
    bounds, bounds_table, clip_to, count_outside, handle_outliers, outlier_report,
)
from tabprep.operators.roles import (
    abs_numeric, coerce_datetime, coerce_numeric, detect_roles, drop_columns, drop_null_rows, roles_table,
)
from tabprep.operators.scale import Scaler
from tabprep.operators.split import split_hash
from tabprep.plans.registry import (
    DIRTY_CUSTOMER_SPARK, DIRTY_CUSTOMER_SQL, DIRTY_DATES_SPARK, DIRTY_DATES_SQL, DIRTY_LINEITEM, DIRTY_LINEITEM_SQL,
    DIRTY_TEXT_SPARK, DIRTY_TEXT_SQL, GAPPY_EVENTS, GAPPY_EVENTS_SQL, NUMBER_SQL, hash_sql, query, rounded, table,
    view,
)
from tabprep.session import shared_dir
from tabprep.sources.files import load, read_any, save

ROWS_PER_BUCKET = 2_000       # small, so that the carry between buckets is at work on small tables too


def _scratch(spark, suffix):
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}{suffix}"


# ---- sources ----

@query("load_csv", """
    select c_custkey as "Cust Key", c_name as "Full Name", c_acctbal as "Acct Bal ($)",
           case when c_custkey % 9 = 0 then null else c_mktsegment end as "Segment",
           c_nationkey % 2 = 0 as "Even"
    from customer""")
def load_csv(spark, sf_dir):
    raw = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as `Cust Key`", "c_name as `Full Name`", "c_acctbal as `Acct Bal ($)`",
        "case when c_custkey % 9 = 0 then 'N/A' else c_mktsegment end as Segment", "c_nationkey % 2 = 0 as Even")
    path = _scratch(spark, ".csv")
    save(raw, path)
    return read_any(spark, path)


@query("load_json", """
    select p_partkey, p_name, p_retailprice, case when p_size > 25 then p_brand end as p_brand from part""")
def load_json(spark, sf_dir):
    path = _scratch(spark, ".json")
    save(table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_name", "p_retailprice", "case when p_size > 25 then p_brand end as p_brand"), path)
    return read_any(spark, path)


@query("save_roundtrip", """
    select o_orderkey, o_totalprice, o_orderstatus, o_orderpriority from orders""")
def save_roundtrip(spark, sf_dir):
    path = _scratch(spark, ".csv")
    save(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"), path)
    return read_any(spark, path)


@query("load_composite", f"""
    select distinct
           case when o_orderkey % 10 <> 0 then date_trunc('day', o_orderdate) end as order_date,
           o_orderpriority as order_priority, {NUMBER_SQL} as total_price_usd, o_totalprice as total_price_usd_1
    from (select o_orderdate, o_orderpriority, o_totalprice, t.*
          from orders join {DIRTY_TEXT_SQL} on orders.o_orderkey = t.o_orderkey)""")
def load_composite(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    raw = orders.selectExpr(
        "case when o_orderkey % 10 = 0 then 'x' else date_format(o_orderdate, 'yyyy-MM-dd') end as `Order Date`",
        "o_orderpriority as `Order\nPriority`",
        DIRTY_TEXT_SPARK[2].replace(" as amount", " as `Total Price (USD)`"),
        "cast(o_totalprice as string) as `total  price -usd-`")
    path = _scratch(spark, ".csv")
    save(raw.unionByName(raw), path)
    return load(spark, path)[0].withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))


# ---- names ----

RAW_HEADERS = ["Order Key", " Part\nKey ", "Supp-Key (id)", "Line  Number", "Qté", "ﬁnal Price $", "__x__", "%", "a", "a", "a_1"]


def _renamed(spark, sf_dir):
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    return table(spark, sf_dir, "lineitem").select(*cols)


@query("standardize_names", """
    select l_orderkey as order_key, l_partkey as part_key, l_suppkey as supp_key_id, l_linenumber as line_number,
           l_quantity as qte, l_extendedprice as final_price, l_discount as x, l_tax as col,
           l_returnflag as a, l_linestatus as a_2, l_shipdate as a_1
    from lineitem""")
def standardize(spark, sf_dir):
    return standardize_names(_renamed(spark, sf_dir).toDF(*RAW_HEADERS))


@query("dedup_names", """
    select o_orderkey as a, o_custkey as a_2, o_orderstatus as a_1, o_totalprice as b, o_orderdate as b_1,
           o_orderpriority as b_2 from orders""")
def dedup(spark, sf_dir):
    return table(spark, sf_dir, "orders").toDF(*unique_names(["a", "a", "a_1", "b", "b", "b"]))


# ---- coercions and roles ----

@query("coerce_numeric", f"select o_orderkey, o_orderstatus, {NUMBER_SQL} as amount from {DIRTY_TEXT_SQL}")
def coerce_numbers(spark, sf_dir):
    return coerce_numeric(view(spark, sf_dir, "orders", DIRTY_TEXT_SPARK), start_col=2)


DAY_SQL = """case when regexp_matches(day, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$')
             then try_strptime(day, '%Y-%m-%d') end"""


@query("coerce_datetime", f"select o_orderkey, o_orderstatus, {DAY_SQL} as day from {DIRTY_DATES_SQL}")
def coerce_dates(spark, sf_dir):
    dated = coerce_datetime(view(spark, sf_dir, "orders", DIRTY_DATES_SPARK))
    return dated.withColumn("day", F.col("day").cast("timestamp_ntz"))


@query("column_roles", f"""
    select column_name as "column",
           case when column_name = 'day' and (select count({DAY_SQL}) from {DIRTY_DATES_SQL}) > 0 then 'datetime'
                when column_type = 'VARCHAR' then 'categorical'
                when column_type like 'TIMESTAMP%' then 'datetime' else 'numeric' end as role
    from (describe select t.*, o_custkey, o_totalprice, o_orderdate from orders
          join {DIRTY_DATES_SQL} on orders.o_orderkey = t.o_orderkey)""")
def column_roles(spark, sf_dir):
    exprs = [*DIRTY_DATES_SPARK, "o_custkey", "o_totalprice", "o_orderdate"]
    return roles_table(*detect_roles(view(spark, sf_dir, "orders", exprs)))


@query("drop_columns", """
    select o_orderkey, o_custkey, o_totalprice, o_orderdate from orders""")
def drop(spark, sf_dir):
    return drop_columns(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority", "not_there"])


@query("abs_numeric", """
    select abs(c_custkey) as c_custkey, c_name, abs(c_nationkey) as c_nationkey, abs(c_acctbal) as c_acctbal,
           c_mktsegment from customer""")
def absolute(spark, sf_dir):
    return abs_numeric(table(spark, sf_dir, "customer"))


@query("drop_null_rows", f"select * from {DIRTY_CUSTOMER_SQL} where segment is not null and nation is not null")
def drop_nulls(spark, sf_dir):
    return drop_null_rows(view(spark, sf_dir, "customer", DIRTY_CUSTOMER_SPARK), ["segment", "nation"])


# ---- missing values ----

def _dirty(spark, sf_dir):
    return view(spark, sf_dir, "lineitem", DIRTY_LINEITEM)


NUM_KEYS = ("l_orderkey", "l_linenumber")


def _fill_sql(value):
    filled = ", ".join(
        f"round(coalesce({c}, (select {value.format(c=c)} from {DIRTY_LINEITEM_SQL})), 8) as {c}"
        for c in ("quantity", "discount"))
    return f"select l_orderkey, l_linenumber, {filled}, l_tax, l_extendedprice from {DIRTY_LINEITEM_SQL}"


def _imputed(spark, sf_dir, **strategies):
    return Imputer(exclude=NUM_KEYS, **strategies).fit_transform(_dirty(spark, sf_dir))


@query("impute_mean", _fill_sql("avg({c})"))
def impute_mean(spark, sf_dir):
    return rounded(_imputed(spark, sf_dir, num_strategy="mean"), 8, ["quantity", "discount"])


@query("impute_median", _fill_sql("quantile_cont({c}, 0.5)"))
def impute_median(spark, sf_dir):
    return rounded(_imputed(spark, sf_dir, num_strategy="median"), 8, ["quantity", "discount"])


def _mode_sql(column, source):
    return f"(select {column} from {source} where {column} is not null group by 1 order by count(*) desc, 1 limit 1)"


@query("impute_mode_num", f"""
    select l_orderkey, l_linenumber, coalesce(quantity, {_mode_sql('quantity', DIRTY_LINEITEM_SQL)}) as quantity,
           coalesce(discount, {_mode_sql('discount', DIRTY_LINEITEM_SQL)}) as discount, l_tax, l_extendedprice
    from {DIRTY_LINEITEM_SQL}""")
def impute_mode_num(spark, sf_dir):
    return _imputed(spark, sf_dir, num_strategy="mode")


@query("impute_mode_cat", f"""
    select c_custkey, c_acctbal, coalesce(segment, {_mode_sql('segment', DIRTY_CUSTOMER_SQL)}) as segment,
           coalesce(nation, {_mode_sql('nation', DIRTY_CUSTOMER_SQL)}) as nation from {DIRTY_CUSTOMER_SQL}""")
def impute_mode_cat(spark, sf_dir):
    return Imputer(cat_strategy="mode", exclude=("c_custkey", "c_acctbal")).fit_transform(
        view(spark, sf_dir, "customer", DIRTY_CUSTOMER_SPARK))


@query("impute_constant", f"""
    select c_custkey, c_acctbal, coalesce(segment, 'Unknown') as segment, coalesce(nation, 'Unknown') as nation
    from {DIRTY_CUSTOMER_SQL}""")
def impute_constant(spark, sf_dir):
    return Imputer(cat_strategy="constant", exclude=("c_custkey", "c_acctbal")).fit_transform(
        view(spark, sf_dir, "customer", DIRTY_CUSTOMER_SPARK))


@query("impute_drop", f"""
    select * from {DIRTY_LINEITEM_SQL} where quantity is not null and discount is not null""")
def impute_drop(spark, sf_dir):
    return _imputed(spark, sf_dir, num_strategy="drop")


TRAIN_SQL = f"(select * from {DIRTY_LINEITEM_SQL} where {hash_sql('l_orderkey', 'l_linenumber')} >= floor(0.2 * 4503599627370496)) tr"
TEST_SQL = f"(select * from {DIRTY_LINEITEM_SQL} where {hash_sql('l_orderkey', 'l_linenumber')} < floor(0.2 * 4503599627370496)) te"


@query("impute_fit_apply", f"""
    select l_orderkey, l_linenumber,
           coalesce(quantity, (select quantile_cont(quantity, 0.5) from {TRAIN_SQL})) as quantity,
           coalesce(discount, (select quantile_cont(discount, 0.5) from {TRAIN_SQL})) as discount, l_tax,
           l_extendedprice
    from {TEST_SQL}""")
def impute_fit_apply(spark, sf_dir):
    train, test = split_hash(_dirty(spark, sf_dir), NUM_KEYS)
    return Imputer(num_strategy="median", exclude=NUM_KEYS).fit(train).transform(test)


def _carry_sql(function, frame, by=""):
    over = f"over ({by} order by ts, event_id {frame})"
    return f"""select event_id, user_id, ts, {function}(value ignore nulls) {over} as value,
               {function}(event_type ignore nulls) {over} as event_type, seen from {GAPPY_EVENTS_SQL}"""


BACK = "rows between unbounded preceding and current row"
AHEAD = "rows between current row and unbounded following"


def _carried(spark, sf_dir, direction, by=()):
    gappy = view(spark, sf_dir, "events", GAPPY_EVENTS)
    return fill(gappy, ["value", "event_type"], ["ts", "event_id"], by, direction, ROWS_PER_BUCKET)


@query("ffill", _carry_sql("last_value", BACK))
def ffill(spark, sf_dir):
    return _carried(spark, sf_dir, "forward")


@query("bfill", _carry_sql("first_value", AHEAD))
def bfill(spark, sf_dir):
    return _carried(spark, sf_dir, "backward")


@query("ffill_by_key", _carry_sql("last_value", BACK, "partition by user_id"))
def ffill_by_key(spark, sf_dir):
    return _carried(spark, sf_dir, "forward", ["user_id"])


@query("bfill_by_key", _carry_sql("first_value", AHEAD, "partition by user_id"))
def bfill_by_key(spark, sf_dir):
    return _carried(spark, sf_dir, "backward", ["user_id"])


@query("impute_datetime", f"""
    select event_id, user_id, ts, value, event_type,
           last_value(seen ignore nulls) over (order by ts, event_id {BACK}) as seen from {GAPPY_EVENTS_SQL}""")
def impute_datetime(spark, sf_dir):
    gappy = view(spark, sf_dir, "events", GAPPY_EVENTS)
    imputer = Imputer(
        dt_strategy="ffill", exclude=("event_id", "user_id", "value", "event_type"), order_by=("ts", "event_id"),
        rows_per_bucket=ROWS_PER_BUCKET)
    return imputer.fit_transform(gappy)


# ---- outliers ----

OUTLIER_COLUMNS = ("quantity", "discount", "l_tax", "l_extendedprice")


def _skewed(spark, sf_dir):
    """The dirty lines with a long tail in the price, so that there is something to cut."""
    return _dirty(spark, sf_dir).withColumn(
        "l_extendedprice", F.expr("case when l_orderkey % 50 = 0 then l_extendedprice * 10 else l_extendedprice end"))


SKEWED_SQL = f"""(select l_orderkey, l_linenumber, quantity, discount, l_tax,
    case when l_orderkey % 50 = 0 then l_extendedprice * 10 else l_extendedprice end as l_extendedprice
    from {DIRTY_LINEITEM_SQL}) s"""


def _limits_sql(method):
    if method == "iqr":
        low = "quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"
        high = "quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"
    else:
        low, high = "avg({c}) - 3 * stddev_samp({c})", "avg({c}) + 3 * stddev_samp({c})"
    cells = ", ".join(f"{low.format(c=c)} as lo_{c}, {high.format(c=c)} as hi_{c}" for c in OUTLIER_COLUMNS)
    return f"(select {cells} from {SKEWED_SQL}) b"


def _bounds_sql(method):
    return " union all ".join(
        f"select '{c}' as \"column\", round(lo_{c}, 6) as low, round(hi_{c}, 6) as high from {_limits_sql(method)}"
        for c in OUTLIER_COLUMNS)


def _drop_sql(method):
    keep = " and ".join(f"{c} between lo_{c} and hi_{c}" for c in OUTLIER_COLUMNS)
    return f"select s.* from {SKEWED_SQL}, {_limits_sql(method)} where {keep}"


def _clip_sql(method):
    cells = ", ".join(
        f"round(case when {c} < lo_{c} then lo_{c} when {c} > hi_{c} then hi_{c} else {c} end, 6) as {c}"
        for c in OUTLIER_COLUMNS)
    return f"select l_orderkey, l_linenumber, {cells} from {SKEWED_SQL}, {_limits_sql(method)}"


def _clipped_sql(method):
    total = " + ".join(
        f"count(*) filter (where {c} < lo_{c} or {c} > hi_{c})" for c in OUTLIER_COLUMNS)
    return f"select cast({total} as bigint) as clipped from {SKEWED_SQL}, {_limits_sql(method)}"


def _report_sql(method):
    keep = " and ".join(f"{c} between lo_{c} and hi_{c}" for c in OUTLIER_COLUMNS)
    moved = " + ".join(
        f"count(*) filter (where {c} < lo_{c} or {c} > hi_{c})" for c in OUTLIER_COLUMNS)
    removed = f"count(*) filter (where not coalesce({keep}, false))"
    return f"""select count(*) as rows, {removed} as rows_removed,
               round({removed} * 100.0 / count(*), 8) as percent_removed, cast({moved} as bigint) as values_clipped
               from {SKEWED_SQL}, {_limits_sql(method)}"""


@query("iqr_bounds", _bounds_sql("iqr"))
def iqr_bounds(spark, sf_dir):
    skewed = _skewed(spark, sf_dir)
    return rounded(bounds_table(skewed, bounds(skewed, "iqr", NUM_KEYS)), 6)


@query("zscore_bounds", _bounds_sql("zscore"))
def zscore_bounds(spark, sf_dir):
    skewed = _skewed(spark, sf_dir)
    return rounded(bounds_table(skewed, bounds(skewed, "zscore", NUM_KEYS)), 6)


@query("outlier_drop_iqr", _drop_sql("iqr"))
def outlier_drop_iqr(spark, sf_dir):
    return handle_outliers(_skewed(spark, sf_dir), "iqr", "drop", NUM_KEYS)


@query("outlier_drop_zscore", _drop_sql("zscore"))
def outlier_drop_zscore(spark, sf_dir):
    return handle_outliers(_skewed(spark, sf_dir), "zscore", "drop", NUM_KEYS)


@query("outlier_clip_iqr", _clip_sql("iqr"))
def outlier_clip_iqr(spark, sf_dir):
    return rounded(handle_outliers(_skewed(spark, sf_dir), "iqr", "clip", NUM_KEYS), 6)


@query("outlier_clip_zscore", _clip_sql("zscore"))
def outlier_clip_zscore(spark, sf_dir):
    skewed = _skewed(spark, sf_dir)
    return rounded(clip_to(skewed, bounds(skewed, "zscore", NUM_KEYS)), 6)


@query("outlier_clip_count", _clipped_sql("iqr"))
def outlier_clip_count(spark, sf_dir):
    skewed = _skewed(spark, sf_dir)
    count = count_outside(skewed, bounds(skewed, "iqr", NUM_KEYS))
    return spark.createDataFrame([(count,)], "clipped bigint")


@query("outlier_report", _report_sql("iqr"))
def report(spark, sf_dir):
    return rounded(outlier_report(_skewed(spark, sf_dir), "iqr", NUM_KEYS), 8)


@query("outlier_isolation_forest")
def isolation(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return IsolationForest(row_key=key).fit_keep(lines, cols)


PLANTED = "l_orderkey % 100 = 1"
FAR_SQL = "l_extendedprice * 50 + 1e7"


@query("outlier_forest_planted", f"""
    select count(*) as rows, count(*) filter (where {PLANTED}) as planted, cast(0 as bigint) as planted_kept,
           true as a_tenth_removed from lineitem""")
def forest_planted(spark, sf_dir):
    """Lines moved far away are all found, and about a tenth of the rows goes."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.expr(PLANTED).alias("planted"), F.expr(f"case when {PLANTED} then {FAR_SQL} else l_extendedprice end").alias("price"),
        F.expr(f"case when {PLANTED} then l_quantity + 1000 else l_quantity end").alias("quantity"), "l_discount", "l_tax")
    flags = IsolationForest().fit_flags(lines, ["price", "quantity", "l_discount", "l_tax"])
    kept = F.count_if(F.col("planted") & ~F.col("outlier"))
    share = F.count_if("outlier") / F.count("*")
    return flags.agg(F.count("*").alias("rows"), F.count_if("planted").alias("planted"), kept.alias("planted_kept"),
                     share.between(0.08, 0.12).alias("a_tenth_removed"))


@query("outlier_forest_report", "select count(*) as rows, true as a_tenth_removed, cast(null as bigint) as values_clipped from lineitem")
def forest_report(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    found = outlier_report(lines, "isolation_forest")
    return found.select("rows", F.col("percent_removed").between(8, 12).alias("a_tenth_removed"), "values_clipped")


# ---- encoding ----

@query("label_encode", f"""
    with seg as (select segment, row_number() over (order by segment) - 1 as code from {DIRTY_CUSTOMER_SQL}
                 where segment is not null group by segment),
         nat as (select nation, row_number() over (order by nation) - 1 as code from {DIRTY_CUSTOMER_SQL}
                 where nation is not null group by nation)
    select c_custkey, c_acctbal, cast(coalesce(seg.code, (select count(*) from seg)) as int) as segment,
           cast(coalesce(nat.code, (select count(*) from nat)) as int) as nation
    from {DIRTY_CUSTOMER_SQL} left join seg on t.segment = seg.segment left join nat on t.nation = nat.nation""")
def label_encode(spark, sf_dir):
    return LabelEncoder().fit_transform(view(spark, sf_dir, "customer", DIRTY_CUSTOMER_SPARK))


SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("onehot", f"""
    select c_custkey, c_acctbal, {', '.join(f"coalesce(segment = '{s}', false) as segment_{s}" for s in SEGMENTS)}
    from {DIRTY_CUSTOMER_SQL}""")
def onehot(spark, sf_dir):
    dirty = view(spark, sf_dir, "customer", DIRTY_CUSTOMER_SPARK).drop("nation")
    return OneHotEncoder().fit_transform(dirty)


# ---- scaling ----

def _scale_sql(offset, width, source, target):
    cells = ", ".join(
        f"""round(({c} - (select {offset.format(c=c)} from {source}))
            / coalesce(nullif((select {width.format(c=c)} from {source}), 0), 1), 6) as {c}"""
        for c in OUTLIER_COLUMNS)
    return f"select l_orderkey, l_linenumber, {cells} from {target}"


@query("scale_standard", _scale_sql("avg({c})", "stddev_pop({c})", DIRTY_LINEITEM_SQL, DIRTY_LINEITEM_SQL))
def scale_standard(spark, sf_dir):
    return rounded(Scaler("standard", NUM_KEYS).fit_transform(_dirty(spark, sf_dir)), 6)


@query("scale_minmax", _scale_sql("min({c})", "max({c}) - min({c})", DIRTY_LINEITEM_SQL, DIRTY_LINEITEM_SQL))
def scale_minmax(spark, sf_dir):
    return rounded(Scaler("minmax", NUM_KEYS).fit_transform(_dirty(spark, sf_dir)), 6)


@query("scale_fit_apply", _scale_sql("avg({c})", "stddev_pop({c})", TRAIN_SQL, TEST_SQL))
def scale_fit_apply(spark, sf_dir):
    train, test = split_hash(_dirty(spark, sf_dir), NUM_KEYS)
    return rounded(Scaler("standard", NUM_KEYS).fit(train).transform(test), 6)
