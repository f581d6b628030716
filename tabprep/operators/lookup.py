"""Joining a large table to a lookup table when single keys may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.operators.stats import col

BROADCAST_ROWS = 100_000      # narrow lookup rows that may go to every task
SALTS = 64
HEAVY_SHARE = 1 / 512         # at most 512 keys can be heavy


def heavy_keys(counts: DataFrame, key: str, n: str, total: int) -> list[Any]:
    """Keys that hold more than HEAVY_SHARE of all rows; their number is bounded by 1 / HEAVY_SHARE."""
    floor = max(total * HEAVY_SHARE, 10_000)
    return [r[0] for r in counts.where(F.col(n) > floor).select(key).collect()]


def lookup(
    df: DataFrame, table: DataFrame, key: str, table_key: str, take: Sequence[str], table_rows: int,
    heavy: Sequence[Any] = (),
) -> DataFrame:
    """Left join the columns ``take`` of a lookup table that is unique on ``table_key``.

    Up to BROADCAST_ROWS lookup rows are broadcast. Beyond that both sides are shuffled on the key, with the heavy
    keys spread over SALTS partitions: their lookup rows are repeated per salt, all other keys use salt 0.
    """
    right = table.select(col(table_key).alias("__rk"), *[col(t) for t in take])
    if table_rows <= BROADCAST_ROWS:
        return df.join(F.broadcast(right), col(key) == F.col("__rk"), "left").drop("__rk")
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    is_heavy = F.col("__rk").isin(list(heavy)) if heavy else F.lit(False)
    right = right.withColumn("__rs", F.explode(F.when(is_heavy, salts).otherwise(F.array(F.lit(0)))))
    spread = F.pmod(F.xxhash64(*[col(c) for c in df.columns]), F.lit(SALTS)).cast("int")
    on_left = col(key).isin(list(heavy)) if heavy else F.lit(False)
    left = df.withColumn("__ls", F.when(on_left | col(key).isNull(), spread).otherwise(F.lit(0)))
    joined = left.join(right, (col(key) == F.col("__rk")) & (F.col("__ls") == F.col("__rs")), "left")
    return joined.drop("__rk", "__rs", "__ls")
