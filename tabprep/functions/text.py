"""Expressions that turn text into numbers, dates and nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The texts a pandas reader takes as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Plain decimals with an optional exponent. Spark alone would also take `1d`, `1f` and `0x1p3`.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Four-digit year, month and day with or without leading zeros, nothing after.
DATE_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def strip(c: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def parse_number(c: Column) -> Column:
    """Text to double: thousands commas and outer blanks go, anything that is no number is null."""
    bare = strip(F.replace(c, F.lit(","), F.lit("")))
    number = F.when(bare.rlike(NUMBER_PATTERN), bare.try_cast("double"))
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def parse_date(c: Column) -> Column:
    """Text to timestamp by year-month-day, null where the text is no such date."""
    return F.when(c.rlike(DATE_PATTERN), F.try_to_timestamp(c, F.lit("yyyy-M-d")))


def missing_to_null(c: Column) -> Column:
    return F.when(~c.isin(MISSING_TOKENS), c)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every floating-point column: Spark sorts NaN above all numbers."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats})
