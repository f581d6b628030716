"""Missing values: statistics fitted on one table, applied unchanged to others."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.operators.ordered import ROWS_PER_BUCKET, fill
from tabprep.operators.quantiles import quantiles
from tabprep.operators.roles import ColumnRoles, drop_null_rows
from tabprep.operators.stats import col, numeric_summary

NUMERIC = ("mean", "median", "mode", "ffill", "bfill", "drop")
CATEGORICAL = ("mode", "constant", "ffill", "bfill", "drop")
DATETIME = ("drop", "ffill", "bfill")
UNKNOWN = "Unknown"
DIRECTIONS = {"ffill": "forward", "bfill": "backward"}


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, Any]:
    """The most frequent value of each column, the lowest of them on a tie; no entry for a column of nulls.

    Values are counted with a map-side combine, so neither a hot value nor a wide range meets in one task.
    """
    out: dict[str, Any] = {}
    for kind, names in _by_type(df, cols).items():
        cells = F.array(*[F.struct(F.lit(c).alias("column"), col(c).alias("value")) for c in names])
        counted = (
            df.select(F.inline(cells)).where(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        )
        best = counted.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"))
        out.update({r["column"]: r["value"] for r in best.collect()})     # one row per column
    return out


def _by_type(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    groups: dict[str, list[str]] = {}
    for c in cols:
        groups.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    return groups


@dataclass(frozen=True)
class ImputerModel:
    """Fitted fill values, and the policies that need none."""

    roles: ColumnRoles
    num_strategy: str
    cat_strategy: str
    dt_strategy: str
    values: Mapping[str, Any]
    order_by: Sequence[str] = ()
    partition_by: Sequence[str] = ()
    rows_per_bucket: int = ROWS_PER_BUCKET

    def transform(self, df: DataFrame) -> DataFrame:
        """Datetime, then numeric, then categorical columns. Fills are literals; only ffill and bfill shuffle.

        Roles that are filled in the same direction share one pass, unless rows are dropped or an order key is filled between.
        """
        out, waiting, towards = df, [], None
        keys = {*self.order_by, *self.partition_by}
        for cols, strategy in (
            (self.roles.datetime, self.dt_strategy), (self.roles.numeric, self.num_strategy),
            (self.roles.categorical, self.cat_strategy),
        ):
            cols = [c for c in cols if c in df.columns]
            carried = strategy in DIRECTIONS
            if waiting and cols and (strategy != towards if carried else strategy == "drop" or keys & set(cols)):
                out, waiting = self._carry(out, waiting, towards), []
            if carried:
                waiting, towards = waiting + cols, strategy
            elif cols:
                out = self._apply(out, cols, strategy)
        return self._carry(out, waiting, towards) if waiting else out

    def _carry(self, df: DataFrame, cols: Sequence[str], strategy: str) -> DataFrame:
        return fill(df, cols, self.order_by, self.partition_by, DIRECTIONS[strategy], self.rows_per_bucket)

    def _apply(self, df: DataFrame, cols: Sequence[str], strategy: str) -> DataFrame:
        if strategy == "drop":
            return drop_null_rows(df, cols)
        fills = {}
        for c in cols:
            if self.values.get(c) is not None:
                have = col(c).cast("double") if strategy in ("mean", "median") else col(c)
                fills[c] = F.coalesce(have, F.lit(self.values[c]))
        return df.withColumns(fills) if fills else df


@dataclass(frozen=True)
class Imputer:
    """Strategies per role. Every column gets a fill value, whether or not it has nulls when fitted."""

    num_strategy: str = "mean"
    cat_strategy: str = "mode"
    dt_strategy: str = "drop"
    exclude: Sequence[str] = field(default_factory=tuple)
    order_by: Sequence[str] = ()
    partition_by: Sequence[str] = ()
    quantile_method: str = "exact"
    rows_per_bucket: int = ROWS_PER_BUCKET

    def __post_init__(self) -> None:
        for given, known, role in (
            (self.num_strategy, NUMERIC, "numeric"), (self.cat_strategy, CATEGORICAL, "categorical"),
            (self.dt_strategy, DATETIME, "datetime"),
        ):
            if given not in known:
                raise ValueError(f"unknown {role} strategy {given!r}, use one of {known}")
        ordered = {"ffill", "bfill"} & {self.num_strategy, self.cat_strategy, self.dt_strategy}
        if ordered and not self.order_by:
            raise ValueError(f"{sorted(ordered)[0]} needs order_by: a table has no row order")

    def fit(self, df: DataFrame) -> ImputerModel:
        whole = ColumnRoles.of(df)
        part = whole.without(self.exclude)
        # The exclusion list does not reach the datetime columns.
        roles = ColumnRoles(part.numeric, part.categorical, whole.datetime)
        keys = set(self.order_by) | set(self.partition_by)
        roles = ColumnRoles(*[
            tuple(c for c in cols if not (strategy in ("ffill", "bfill") and c in keys))
            for cols, strategy in (
                (roles.numeric, self.num_strategy), (roles.categorical, self.cat_strategy),
                (roles.datetime, self.dt_strategy))
        ])
        values: dict[str, Any] = {}
        if self.num_strategy == "mean":
            got = numeric_summary(df, roles.numeric, ("mean",))
            values.update({c: got[c]["mean"] for c in roles.numeric})
        elif self.num_strategy == "median":
            middle = quantiles(df, roles.numeric, (0.5,), self.quantile_method)
            values.update({c: middle[c][0.5] for c in roles.numeric})
        counted = list(roles.numeric) if self.num_strategy == "mode" else []
        if self.cat_strategy == "mode":
            counted += roles.categorical
            values.update(dict.fromkeys(roles.categorical, UNKNOWN))
        elif self.cat_strategy == "constant":
            values.update(dict.fromkeys(roles.categorical, UNKNOWN))
        if counted:
            values.update(modes(df, counted))
        return ImputerModel(
            roles, self.num_strategy, self.cat_strategy, self.dt_strategy, values,
            tuple(self.order_by), tuple(self.partition_by), self.rows_per_bucket)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)
