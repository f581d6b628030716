"""Seeded splits that depend on a row key only, never on partitioning."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.hashing import hash_below, row_hash
from tabprep.operators.quantiles import order_statistics
from tabprep.operators.stats import col
from tabprep.session import shared_dir


def split_hash(
    df: DataFrame, key: Sequence[str], test_size: float = 0.2, seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Train and test parts by a hash of the key: two filters, no shuffle. The test share is met on average."""
    _check_share(test_size)
    in_test = hash_below(key, test_size, seed)
    return df.where(~in_test), df.where(in_test)


def split_exact(
    df: DataFrame, key: Sequence[str], test_size: float = 0.2, seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Train and test parts with exactly ``ceil(test_size * rows)`` test rows: those with the lowest hashes.

    The cut is an order statistic of the key's hash, applied as a filter, so nothing is sorted whole. Rows with the
    key hash of the cut are told apart by an order statistic of the hash of the whole row. What agrees in that too is equal rows:
    they are written out once with a number each, in every task by itself, and cut by it.
    """
    _check_share(test_size)
    every = [col(c) for c in df.columns] + [col(c).isNull() for c in df.columns]         # a hash passes over nulls
    hashed = df.withColumns({"__h": row_hash(key, seed), "__r": F.xxhash64(F.lit(seed), *every)})
    rows = df.count()
    wanted = math.ceil(test_size * rows)
    if rows == 0 or wanted == 0:
        return df, df.where(F.lit(False))
    h, needed, ties = _cut(hashed, "__h", wanted)
    first, tied = F.col("__h") < h, F.col("__h") == h
    if ties == needed:
        return _parts(hashed, first | tied)
    r, needed, ties = _cut(hashed.where(tied), "__r", needed)
    first, tied = first | (tied & (F.col("__r") < r)), tied & (F.col("__r") == r)
    if ties == needed:
        return _parts(hashed, first | tied)
    path = f"{shared_dir(df.sparkSession)}/split-{uuid.uuid4().hex}"
    hashed.where(tied).withColumn("__p", F.monotonically_increasing_id()).write.parquet(path)
    equal = df.sparkSession.read.parquet(path)
    p, _, _ = _cut(equal, "__p", needed)
    train, test = _parts(hashed.where(~tied), first)
    more_train, more_test = _parts(equal, F.col("__p") <= p)
    return train.unionByName(more_train), test.unionByName(more_test)


def _cut(rows: DataFrame, name: str, wanted: int) -> tuple[int, int, int]:
    """The ``wanted``-th least number, how many rows with it are wanted, and how many there are."""
    cut = order_statistics(rows, {name: [wanted - 1]}, whole=True)[name][wanted - 1]
    at = rows.agg(F.count_if(F.col(name) < cut).alias("below"), F.count_if(F.col(name) == cut).alias("ties")).first()
    return cut, wanted - at["below"], at["ties"]


def _parts(rows: DataFrame, in_test: Column) -> tuple[DataFrame, DataFrame]:
    hidden = ("__h", "__r", "__p")
    return rows.where(~in_test).drop(*hidden), rows.where(in_test).drop(*hidden)


def assign_folds(df: DataFrame, key: Sequence[str], folds: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Add a fold number 0..folds-1 by the hash of the key."""
    if folds < 2:
        raise ValueError("at least two folds are needed")
    return df.withColumn(name, (row_hash(key, seed) % folds).cast("int"))


def fold_sizes(df: DataFrame, name: str = "fold") -> DataFrame:
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("rows"))


def _check_share(test_size: float) -> None:
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must lie strictly between 0 and 1")
