"""One-row aggregates: as many statistics per scan as the generated code can carry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Aggregate expressions per scan. Beyond this the generated method is too large for the JVM to compile and runs several
# times slower; with expressions listed column by column, each further scan reads only its own columns.
CHUNK = 60


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col(f"`{name}`")


def one_row(df: DataFrame, exprs: Mapping[Any, Column], chunk: int = CHUNK) -> dict[Any, Any]:
    """Evaluate aggregate expressions over the whole table and return them by key."""
    keys = list(exprs)
    out: dict[Any, Any] = {}
    for start in range(0, len(keys), chunk):
        part = keys[start:start + chunk]
        row = df.agg(*[exprs[k].alias(f"a{i}") for i, k in enumerate(part)]).first()
        out.update(zip(part, row))
    return out


def numeric_summary(df: DataFrame, cols: Sequence[str], wanted: Sequence[str]) -> dict[str, dict[str, Any]]:
    """``{column: {statistic: value}}`` for count, mean, std, std_pop, min and max in one scan."""
    make = {
        "count": F.count,
        "mean": lambda c: F.avg(c),
        "std": lambda c: F.stddev_samp(c),
        "std_pop": lambda c: F.stddev_pop(c),
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    got = one_row(df, {(c, w): make[w](col(c)) for c in cols for w in wanted})
    return {c: {w: got[c, w] for w in wanted} for c in cols}


def long_values(df: DataFrame, cols: Sequence[str], as_type: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows ``(keep..., column, value)``: one per cell of the named columns, in one scan."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), col(c).cast(as_type).alias("value")) for c in cols
    ])
    return df.select(*[col(k) for k in keep], F.inline(cells))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` of the non-null values as text, combined on the map side first."""
    cells = long_values(df, cols, "string").where(F.col("value").isNotNull())
    return cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
