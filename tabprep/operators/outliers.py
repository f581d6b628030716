"""Outlier bounds, dropping and clipping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.operators.quantiles import quantiles
from tabprep.operators.roles import ColumnRoles
from tabprep.operators.stats import col, numeric_summary, one_row

Bounds = Mapping[str, tuple[float | None, float | None]]
METHODS = ("iqr", "zscore", "isolation_forest")
STRATEGIES = ("drop", "clip")


def bounds(
    df: DataFrame, method: str = "iqr", exclude: Sequence[str] = (), quantile_method: str = "exact",
) -> dict[str, tuple[float | None, float | None]]:
    """``{column: (low, high)}`` of every numeric column: quartiles ± 1.5 IQR, or mean ± 3 sample deviations."""
    cols = ColumnRoles.of(df).without(exclude).numeric
    if method == "iqr":
        got = quantiles(df, cols, (0.25, 0.75), quantile_method)
        return {c: iqr_fence(got[c][0.25], got[c][0.75]) for c in cols}
    if method == "zscore":
        stats = numeric_summary(df, cols, ("mean", "std", "min", "max"))
        out: dict[str, tuple[float | None, float | None]] = {}
        for c in cols:
            mean, std = stats[c]["mean"], stats[c]["std"]
            known = mean is not None and std is not None
            if known and stats[c]["min"] == stats[c]["max"]:       # the mean of equal values may be off in its last digits
                out[c] = (float(stats[c]["min"]), float(stats[c]["min"]))
                continue
            out[c] = (mean - 3 * std, mean + 3 * std) if known else (None, None)
        return out
    raise ValueError(f"no bounds for method {method!r}, use 'iqr' or 'zscore'")


def iqr_fence(q1: float | None, q3: float | None) -> tuple[float | None, float | None]:
    if q1 is None or q3 is None:
        return None, None
    reach = 1.5 * (q3 - q1)
    return q1 - reach, q3 + reach


def bounds_table(df: DataFrame, limits: Bounds) -> DataFrame:
    rows = [(c, lo, hi) for c, (lo, hi) in limits.items()]
    return df.sparkSession.createDataFrame(rows, "column string, low double, high double")


def drop_outside(df: DataFrame, limits: Bounds) -> DataFrame:
    """Keep rows that are within the bounds in every column; a null in one of them drops the row too."""
    if not limits:
        return df
    return df.where(reduce(and_, [
        col(c).between(F.lit(lo).cast("double"), F.lit(hi).cast("double")) for c, (lo, hi) in limits.items()
    ]))


def clip_to(df: DataFrame, limits: Bounds) -> DataFrame:
    """Move values outside the bounds onto them; nulls stay null."""
    known = {c: b for c, b in limits.items() if b[0] is not None}
    if not known:
        return df
    return df.withColumns({
        c: F.when(col(c) < lo, lo).when(col(c) > hi, hi).otherwise(col(c).cast("double"))
        for c, (lo, hi) in known.items()
    })


def count_outside(df: DataFrame, limits: Bounds) -> int:
    """How many values, over all columns, lie strictly outside their bounds."""
    known = {c: b for c, b in limits.items() if b[0] is not None}
    got = one_row(df, {c: F.count_if((col(c) < lo) | (col(c) > hi)) for c, (lo, hi) in known.items()})
    return sum(got.values())


def handle_outliers(
    df: DataFrame, method: str = "iqr", strategy: str = "drop", exclude: Sequence[str] = (),
    quantile_method: str = "exact", row_key: Sequence[str] | None = None,
) -> DataFrame:
    """Drop or clip outliers, with bounds from the table passed in. Meant for training data only."""
    if method not in METHODS:
        raise ValueError(f"unknown outlier method {method!r}, use one of {METHODS}")
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown outlier strategy {strategy!r}, use one of {STRATEGIES}")
    if method == "isolation_forest":
        if strategy == "clip":
            raise NotImplementedError("an isolation forest has no bounds to clip to")
        from tabprep.operators.iforest import IsolationForest
        cols = ColumnRoles.of(df).without(exclude).numeric
        return IsolationForest(row_key=row_key).fit_keep(df, cols) if cols else df
    limits = bounds(df, method, exclude, quantile_method)
    return drop_outside(df, limits) if strategy == "drop" else clip_to(df, limits)


def outlier_report(
    df: DataFrame, method: str = "iqr", exclude: Sequence[str] = (), quantile_method: str = "exact",
    row_key: Sequence[str] | None = None,
) -> DataFrame:
    """One row: rows, rows a drop removes, their percentage, and values a clip would move.

    Both counts come from one scan with the bounds in place. A forest has no bounds to clip to: its last number is null.
    """
    if method == "isolation_forest":
        from tabprep.operators.iforest import IsolationForest
        rows, removed = IsolationForest(row_key=row_key).count_outliers(df, ColumnRoles.of(df).without(exclude).numeric)
        return df.sparkSession.createDataFrame(
            [(rows, removed, removed * 100.0 / rows, None)], "rows bigint, rows_removed bigint, percent_removed double, values_clipped bigint")
    limits = bounds(df, method, exclude, quantile_method)
    known = {c: b for c, b in limits.items() if b[0] is not None}
    inside = reduce(and_, [
        col(c).between(F.lit(lo).cast("double"), F.lit(hi).cast("double")) for c, (lo, hi) in limits.items()
    ], F.lit(True))
    moved = reduce(lambda a, b: a + b, [
        F.count_if((col(c) < lo) | (col(c) > hi)) for c, (lo, hi) in known.items()
    ], F.lit(0).cast("bigint"))
    rows = F.count(F.lit(1))
    removed = F.count_if(~F.coalesce(inside, F.lit(False)))
    return df.agg(
        rows.alias("rows"), removed.alias("rows_removed"),
        (removed * 100.0 / F.nullif(rows, F.lit(0))).cast("double").alias("percent_removed"),
        moved.alias("values_clipped"),
    )
