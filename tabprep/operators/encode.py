"""Label and one-hot encoding of text columns."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.operators.lookup import HEAVY_SHARE, lookup
from tabprep.operators.roles import ColumnRoles
from tabprep.operators.stats import col, value_counts
from tabprep.session import shared_dir

WINDOW_VALUES = 1_000_000     # distinct values per column that may be numbered by one window
MAX_DUMMIES = 1_000           # one-hot columns per source column before it is an error


@dataclass(frozen=True)
class LabelEncoderModel:
    """The codes as a table ``(column, value, code)``, written once so that every use sees the same ones."""

    columns: tuple[str, ...]
    mapping: DataFrame
    sizes: Mapping[str, int]
    heavy: Mapping[str, Sequence[str]]
    unseen: str

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace each fitted column by its code. Null takes the code after the last one."""
        out = df
        for c in self.columns:
            if c not in df.columns:
                continue
            codes = self.mapping.where(F.col("column") == c).select("value", "code")
            size = self.sizes.get(c, 0)
            joined = lookup(out, codes, c, "value", ["code"], size, self.heavy.get(c, ()))
            code = F.when(col(c).isNull(), F.lit(size)).otherwise(F.col("code"))
            if self.unseen == "error":
                code = F.when(col(c).isNotNull() & F.col("code").isNull(), F.raise_error(
                    F.concat(F.lit(f"value of {c} not seen when the encoder was fitted: "), col(c))
                ).cast("int")).otherwise(code)
            out = joined.withColumn(c, code.cast("int")).drop("code")
        return out


@dataclass(frozen=True)
class LabelEncoder:
    """Codes 0..k-1 in sorted order of the distinct values of each text column."""

    columns: Sequence[str] | None = None
    unseen: str = "error"
    window_values: int = WINDOW_VALUES

    def __post_init__(self) -> None:
        if self.unseen not in ("error", "null"):
            raise ValueError(f"unseen must be 'error' or 'null', not {self.unseen!r}")

    def fit(self, df: DataFrame) -> LabelEncoderModel:
        columns = tuple(self.columns or ColumnRoles.of(df).categorical)
        counts = value_counts(df, columns)
        folder = f"{shared_dir(df.sparkSession)}/codes-{uuid.uuid4().hex}"
        counts.write.parquet(f"{folder}/counts")
        counts = df.sparkSession.read.parquet(f"{folder}/counts")
        facts = counts.groupBy("column").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("rows")).collect()
        sizes = {r["column"]: r["k"] for r in facts}
        floors = {r["column"]: max(r["rows"] * HEAVY_SHARE, 10_000) for r in facts}
        heavy: dict[str, list[str]] = {}
        for c, floor in floors.items():
            heavy[c] = [r[0] for r in counts.where((F.col("column") == c) & (F.col("n") > floor)).select("value").collect()]
        number = _number_by_window if max(sizes.values(), default=0) <= self.window_values else _number_by_range
        number(counts.select("column", "value"), folder).write.parquet(f"{folder}/mapping")
        return LabelEncoderModel(
            columns, df.sparkSession.read.parquet(f"{folder}/mapping"), sizes, heavy, self.unseen)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


def _number_by_window(values: DataFrame, folder: str) -> DataFrame:
    order = Window.partitionBy("column").orderBy("value")
    return values.withColumn("code", (F.row_number().over(order) - 1).cast("int"))


def _number_by_range(values: DataFrame, folder: str, parts: int = 200) -> DataFrame:
    """Number within range partitions and add the sizes of earlier ones.

    The partition number is written out before it is used, so it cannot change on a recomputation.
    """
    cut = values.repartitionByRange(parts, "column", "value").withColumn("part", F.spark_partition_id())
    cut.write.parquet(f"{folder}/ranges")
    cut = values.sparkSession.read.parquet(f"{folder}/ranges")
    past = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy("column", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "column", "part", F.coalesce(F.sum("n").over(past), F.lit(0)).alias("offset"))
    local = cut.withColumn("rn", F.row_number().over(Window.partitionBy("column", "part").orderBy("value")) - 1)
    # One offset per column and range partition.
    numbered = local.join(F.broadcast(offsets), ["column", "part"])
    return numbered.select("column", "value", (F.col("rn") + F.col("offset")).cast("int").alias("code"))


@dataclass(frozen=True)
class OneHotEncoderModel:
    """The sorted values per column; the first of them has no dummy."""

    categories: Mapping[str, Sequence[str]]

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace each column by boolean columns ``{column}_{value}``; a null row is false in all of them."""
        kept = [col(c) for c in df.columns if c not in self.categories]
        dummies = [
            F.coalesce(col(c) == F.lit(v), F.lit(False)).alias(f"{c}_{v}")
            for c, values in self.categories.items() for v in values[1:]
        ]
        return df.select(*kept, *dummies)


@dataclass(frozen=True)
class OneHotEncoder:
    columns: Sequence[str] | None = None
    max_dummies: int | None = MAX_DUMMIES

    def fit(self, df: DataFrame) -> OneHotEncoderModel:
        """Collect the distinct values, one per column of the result.

        A column with more than ``max_dummies`` of them is an error; None sets no limit.
        """
        columns = tuple(self.columns or ColumnRoles.of(df).categorical)
        if not columns:
            return OneHotEncoderModel({})
        found = value_counts(df, columns).select("column", "value")
        most = self.max_dummies
        seen = found.collect() if most is None else found.take(most * len(columns) + 1)
        values: dict[str, list[str]] = {c: [] for c in columns}
        for column, value in seen:
            values[column].append(value)
        wide = [] if most is None else [c for c in columns if len(values[c]) > most]
        if wide:
            raise ValueError(f"too many distinct values to one-hot encode: {wide}")
        return OneHotEncoderModel({c: sorted(values[c]) for c in columns})

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


def encode_categorical(df: DataFrame, strategy: str = "onehot", columns: Sequence[str] | None = None) -> DataFrame:
    if strategy == "label":
        return LabelEncoder(columns).fit_transform(df)
    if strategy == "onehot":
        return OneHotEncoder(columns).fit_transform(df)
    raise ValueError(f"unknown encoding {strategy!r}, use 'label' or 'onehot'")
