"""Named queries over the driver tables, each with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.operators.stats import col

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FOREST_PARTS = 32


def bagged(lines: DataFrame, *key: str) -> DataFrame:
    """Rows in a fixed number of parts and in a fixed order: forests draw their bags part by part, so the answer must
    not depend on cores or file splits."""
    return lines.repartition(FOREST_PARTS, *key).sortWithinPartitions(*lines.columns)


def rounded(df: DataFrame, digits: Mapping[str, int] | int, cols: list[str] | None = None) -> DataFrame:
    """Round doubles where the last digits depend on the order of a sum."""
    if isinstance(digits, int):
        names = cols or [n for n, t in df.dtypes if t == "double"]
        digits = dict.fromkeys(names, digits)
    return df.withColumns({c: F.round(col(c), d) for c, d in digits.items()})


# The driver tables are clean; these views dirty them. Each is given in Spark SQL and in the oracle's dialect.
DIRTY_LINEITEM = [
    "l_orderkey", "l_linenumber",
    "case when l_partkey % 11 = 0 then null else l_quantity end as quantity",
    "case when l_suppkey % 7 = 0 then null else l_discount end as discount",
    "l_tax", "l_extendedprice",
]
DIRTY_LINEITEM_SQL = "(select " + ", ".join(DIRTY_LINEITEM) + " from lineitem) t"

DIRTY_TEXT = [
    "o_orderkey", "o_orderstatus",
    "case when o_orderkey % 13 = 0 then '<1' when o_orderkey % 17 = 0 then 'N/A' when o_orderkey % 7 = 0 then '1d' "
    "when o_orderkey % 29 = 0 then concat(chr(9), '5', chr(10)) when o_orderkey % 19 = 0 then '1_000' when o_orderkey % 23 = 0 then '-2.5e3' "
    "else concat(' ', cast(o_orderkey as {text}), ',000 ') end as amount",
]
DIRTY_TEXT_SPARK = [e.replace("{text}", "string") for e in DIRTY_TEXT]
DIRTY_TEXT_SQL = "(select " + ", ".join(DIRTY_TEXT).replace("{text}", "varchar") + " from orders) t"
NUMBER_SQL = (
    "case when regexp_matches(regexp_replace(replace(amount, ',', ''), '^\\s+|\\s+$', '', 'g'), '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$') "
    "then cast(regexp_replace(replace(amount, ',', ''), '^\\s+|\\s+$', '', 'g') as double) end"
)

DIRTY_DATES = "o_orderkey", "o_orderstatus", "case when o_orderkey % 10 = 0 then 'x' else {day} end as day"
DIRTY_DATES_SPARK = [e.replace("{day}", "date_format(o_orderdate, 'yyyy-MM-dd')") for e in DIRTY_DATES]
DIRTY_DATES_SQL = "(select " + ", ".join(DIRTY_DATES).replace("{day}", "strftime(o_orderdate, '%Y-%m-%d')") + " from orders) t"

DIRTY_CUSTOMER = [
    "c_custkey", "c_acctbal", "case when c_custkey % 9 = 0 then null else c_mktsegment end as segment",
    "case when c_custkey % 4 = 0 then null else cast(c_nationkey as {text}) end as nation",
]
DIRTY_CUSTOMER_SPARK = [e.replace("{text}", "string") for e in DIRTY_CUSTOMER]
DIRTY_CUSTOMER_SQL = "(select " + ", ".join(DIRTY_CUSTOMER).replace("{text}", "varchar") + " from customer) t"

GAPPY_EVENTS = [
    "event_id", "user_id", "ts",
    "case when event_id % 3 = 0 and event_id not between 0 and 900 and event_id not between 4000 and 5999 "
    "then value end as value",
    "case when event_id % 5 = 1 then event_type end as event_type",
    "case when event_id % 4 = 2 then ts end as seen",
]
GAPPY_EVENTS_SQL = "(select " + ", ".join(GAPPY_EVENTS) + " from events) t"


def view(spark: SparkSession, sf_dir: str, base: str, exprs: list[str]) -> DataFrame:
    return table(spark, sf_dir, base).selectExpr(*exprs)


def hash_sql(*key: str, seed: int = 42) -> str:
    """The row hash as SQL."""
    parts = ", ".join(f"cast({k} as varchar)" for k in key)
    return f"cast('0x' || substr(md5(concat_ws(':', '{seed}', {parts})), 1, 13) as bigint)"
