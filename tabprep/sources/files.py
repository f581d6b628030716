"""Reading and writing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.names import standardize_names, unique_names
from tabprep.functions.text import NUMBER_PATTERN, missing_to_null, nan_to_null, strip
from tabprep.operators.roles import ColumnRoles, coerce_numeric, detect_roles
from tabprep.operators.stats import col, one_row

SUFFIXES = {".csv": "csv", ".json": "json", ".parquet": "parquet"}
WHOLE_PATTERN = r"^\s*[+-]?[0-9]{1,18}\s*$"
# The texts a pandas reader takes as booleans.
TRUE_TEXTS = ["True", "TRUE", "true"]
FALSE_TEXTS = ["False", "FALSE", "false"]


def file_format(path: str) -> str:
    """The format a path names by its suffix."""
    for suffix, name in SUFFIXES.items():
        if path.rstrip("/").lower().endswith(suffix):
            return name
    raise ValueError(f"unsupported file format, use one of {', '.join(SUFFIXES)}: {path}")


def spans_lines(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field runs over a line end: some line then has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).limit(1).isEmpty()


def read_csv(spark: SparkSession, path: str, multi_line: bool | None = None, infer: bool = True) -> DataFrame:
    """A CSV file with a header row.

    Files whose quoted fields hold line ends must be read whole by one task each; all others are split. By default
    a scan of the lines decides. ``infer`` gives columns a number or boolean type where every value fits.
    """
    if multi_line is None:
        multi_line = spans_lines(spark, path)
    reader = spark.read.option("multiLine", multi_line).option("escape", '"').option("inferSchema", False)
    header = reader.option("header", False).csv(path).first()
    if header is None:
        raise ValueError(f"no header row in {path}")
    raw = [h if h else f"Unnamed: {i}" for i, h in enumerate(header)]
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(raw))])
    text = reader.option("header", True).option("enforceSchema", True).schema(schema).csv(path)
    named = text.toDF(*unique_names(raw))
    named = named.select(*[missing_to_null(col(c)).alias(c) for c in named.columns])
    return infer_types(named) if infer else named


def infer_types(df: DataFrame) -> DataFrame:
    """Give text columns the narrowest of bigint, double, boolean that all their values fit.

    A column without any value becomes double. One scan for all columns.
    """
    exprs = {}
    for c in ColumnRoles.of(df).categorical:
        exprs[c, "values"] = F.count(col(c))
        exprs[c, "whole"] = F.count_if(col(c).rlike(WHOLE_PATTERN))
        exprs[c, "number"] = F.count_if(strip(col(c)).rlike(NUMBER_PATTERN))
        exprs[c, "boolean"] = F.count_if(col(c).isin(TRUE_TEXTS + FALSE_TEXTS))
    got = one_row(df, exprs)
    changed = {}
    for c in ColumnRoles.of(df).categorical:
        values = got[c, "values"]
        if values and got[c, "whole"] == values:
            changed[c] = strip(col(c)).try_cast("bigint")
        elif got[c, "number"] == values:
            changed[c] = strip(col(c)).try_cast("double")
        elif got[c, "boolean"] == values:
            changed[c] = col(c).isin(TRUE_TEXTS)
    return df.withColumns(changed) if changed else df


def read_json(spark: SparkSession, path: str, lines: bool | None = None) -> DataFrame:
    """A JSON array of records, or one record per line. By default the first line decides.

    An array is one document, so each file of that kind is read by one task; prefer lines for large data.
    """
    if lines is None:
        first = spark.read.text(path).where(F.trim("value") != "").first()
        lines = first is not None and not first[0].lstrip().startswith("[")
    return spark.read.json(path, multiLine=not lines)


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Read by suffix. A path that does not exist raises Spark's own error."""
    kind = file_format(path)
    if kind == "csv":
        return read_csv(spark, path)
    if kind == "json":
        return read_json(spark, path)
    return spark.read.parquet(path)


def load(
    spark: SparkSession, path: str, numeric_from: int = 2, min_date_share: float = 0.0,
) -> tuple[DataFrame, ColumnRoles]:
    """Read, clean the names, parse numbers from column ``numeric_from`` on, drop repeated rows, detect roles."""
    return prepare_loaded(read_any(spark, path), numeric_from, min_date_share)


def prepare_loaded(df: DataFrame, numeric_from: int = 2, min_date_share: float = 0.0) -> tuple[DataFrame, ColumnRoles]:
    """Everything ``load`` does after reading, for tables that come from elsewhere."""
    named = standardize_names(df)
    numbers = coerce_numeric(named, numeric_from)
    return detect_roles(nan_to_null(numbers).distinct(), min_date_share)


def save(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write by suffix, as a folder of part files."""
    kind = file_format(path)
    writer = df.write.mode(mode)
    if kind == "csv":
        writer.csv(path, header=True, escape='"')
    elif kind == "json":
        writer.json(path)
    else:
        writer.parquet(path)
