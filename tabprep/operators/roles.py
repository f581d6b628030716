"""Column roles and the coercions that decide them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.text import parse_date, parse_number
from tabprep.operators.stats import col, one_row


@dataclass(frozen=True)
class ColumnRoles:
    """The numeric, categorical and datetime columns of a table, in table order."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    datetime: tuple[str, ...]

    @classmethod
    def of(cls, df: DataFrame) -> ColumnRoles:
        """Read the roles off the schema. Booleans, arrays, maps and structs have none."""
        def named(*kinds: type) -> tuple[str, ...]:
            return tuple(f.name for f in df.schema if isinstance(f.dataType, kinds))

        return cls(
            named(T.NumericType), named(T.StringType),
            named(T.TimestampType, T.TimestampNTZType, T.DateType),
        )

    def without(self, exclude: Sequence[str]) -> ColumnRoles:
        out = set(exclude)
        return ColumnRoles(*[
            tuple(c for c in cols if c not in out) for cols in (self.numeric, self.categorical, self.datetime)
        ])


def numeric_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """The numeric columns of the table, or the named ones after a check that they are numeric."""
    numeric = ColumnRoles.of(df).numeric
    if cols is None:
        return list(numeric)
    wrong = [c for c in cols if c not in numeric]
    if wrong:
        raise ValueError(f"not numeric columns: {wrong}")
    return list(cols)


def coerce_numeric(df: DataFrame, start_col: int = 2, cols: Sequence[str] | None = None) -> DataFrame:
    """Parse text columns from position ``start_col`` on (or the named ones) as doubles."""
    names = df.columns[start_col:] if cols is None else cols
    text = [c for c in ColumnRoles.of(df).categorical if c in names]
    return df.withColumns({c: parse_number(col(c)) for c in text}) if text else df


def coerce_datetime(df: DataFrame, min_date_share: float = 0.0) -> DataFrame:
    """Turn a text column into timestamps if a value parses as a date; what does not parse becomes null.

    By default one date is enough. ``min_date_share`` asks for that share of the non-null values.
    """
    text = ColumnRoles.of(df).categorical
    if not text:
        return df
    exprs = {}
    for c in text:
        exprs[c, "dates"] = F.count(parse_date(col(c)))
        exprs[c, "values"] = F.count(col(c))
    got = one_row(df, exprs)
    dates = [
        c for c in text
        if got[c, "dates"] > 0 and got[c, "dates"] >= min_date_share * got[c, "values"]
    ]
    return df.withColumns({c: parse_date(col(c)) for c in dates}) if dates else df


def detect_roles(df: DataFrame, min_date_share: float = 0.0) -> tuple[DataFrame, ColumnRoles]:
    """Coerce text dates, then read the roles."""
    out = coerce_datetime(df, min_date_share)
    return out, ColumnRoles.of(out)


def roles_table(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """The roles as rows ``(column, role)``."""
    rows = [(c, r) for r in ("numeric", "categorical", "datetime") for c in getattr(roles, r)]
    return df.sparkSession.createDataFrame(rows, "column string, role string")


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns by name; names the table does not have are ignored."""
    return df.drop(*cols)


def abs_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Absolute value of every numeric column, or of the named ones."""
    names = numeric_columns(df, cols)
    return df.withColumns({c: F.abs(col(c)) for c in names}) if names else df


def drop_null_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols)) if cols else df
