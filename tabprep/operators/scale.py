"""Standard and min-max scaling, fitted once and applied as plain projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.operators.roles import ColumnRoles
from tabprep.operators.stats import col, numeric_summary

STRATEGIES = ("standard", "minmax")


@dataclass(frozen=True)
class ScalerModel:
    """Per column an offset and a width; scaling is ``(x - offset) / width``."""

    strategy: str
    columns: Mapping[str, tuple[float, float]]

    def transform(self, df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
        """Scale the fitted columns the table has. Nulls stay null."""
        use = {c: v for c, v in self.columns.items() if c in df.columns and c not in exclude}
        if not use:
            return df
        return df.withColumns({
            c: (col(c).cast("double") - F.lit(offset)) / F.lit(width) for c, (offset, width) in use.items()
        })


@dataclass(frozen=True)
class Scaler:
    strategy: str = "standard"
    exclude: Sequence[str] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        if self.strategy not in STRATEGIES:
            raise ValueError(f"unknown scaling strategy {self.strategy!r}, use one of {STRATEGIES}")

    def fit(self, df: DataFrame) -> ScalerModel:
        """One scan. A constant column gets width 1, so it scales to 0; a column of nulls is left alone."""
        cols = ColumnRoles.of(df).without(self.exclude).numeric
        low, high = ("mean", "std_pop") if self.strategy == "standard" else ("min", "max")
        got = numeric_summary(df, cols, tuple(dict.fromkeys((low, high, "min", "max"))))
        fitted = {}
        for c in cols:
            offset, edge = got[c][low], got[c][high]
            if offset is None:
                continue
            if got[c]["min"] == got[c]["max"]:                 # exactly 0 after scaling
                fitted[c] = (float(got[c]["min"]), 1.0)
                continue
            width = edge if self.strategy == "standard" else edge - offset
            fitted[c] = (float(offset), float(width) or 1.0)
        return ScalerModel(self.strategy, fitted)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)
