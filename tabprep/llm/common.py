"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabprep.session import shared_dir

SPACE = "[\\x20\\x09-\\x0D]+"                          # what separates words
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_BYTES = 32 << 20                             # a side is broadcast only if it was measured to be below this
SALTS = 32


def name(column: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + column.replace("`", "``") + "`")


def body(text: str | Column = "text") -> Column:
    """A text column in which null is the empty text."""
    return F.coalesce(name(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column, gap: str = SPACE) -> Column:
    """The runs of characters between gaps, in order."""
    return F.array_remove(F.split(text, gap), "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute a value once per row and use it many times, also inside other lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def checkpointed(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and cut its lineage, so that later reads see one fixed version."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Like ``checkpointed``, as a columnar table: rows of numbers take a fraction of the space of a checkpoint."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class Scratch:
    """Columnar tables in the shared folder that are removed when their last reader is done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.made = spark, f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}", 0

    def keep(self, df: DataFrame) -> tuple[DataFrame, str]:
        path, self.made = f"{self.folder}/{self.made}", self.made + 1
        df.write.parquet(path)
        return self.spark.read.parquet(path), path

    def drop(self, *paths: str) -> None:
        for text in paths:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(text)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def small_table(spark: SparkSession, rows: Sequence[dict], fields: str) -> DataFrame:
    """A table of planned numbers as a literal; for sizes fixed by a parameter."""
    literal = F.from_json(F.lit(json.dumps(list(rows))), f"array<struct<{fields}>>")
    return spark.range(1).select(F.inline(literal))


def with_lookup(left: DataFrame, right: DataFrame, key: str, spread: Column, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Left join to a table with one row per text key, null matching null.

    The right side is broadcast if its measured size is below a bound. Else the rows of every left key are dealt
    over salts by ``spread`` and the right side is repeated once per salt, so no key fills a task.
    """
    right = right.withColumnRenamed(key, "__key")
    found = right.agg(F.sum(F.octet_length(F.to_json(F.struct(*[name(c) for c in right.columns]))) + 32)).first()[0] or 0
    same = name(key).eqNullSafe(F.col("__key"))
    if found <= max_bytes:
        return left.join(F.broadcast(right), same, "left").drop("__key")
    salted = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = left.withColumn("__at", F.pmod(spread, F.lit(SALTS)).cast("int"))
    return out.join(salted, same & (F.col("__at") == F.col("__salt")), "left").drop("__key", "__salt", "__at")


def numbered(df: DataFrame, order: Column, column: str, parts: int = 200) -> DataFrame:
    """Number rows from 1 by a total order: range parts are numbered by themselves and offset by the parts before."""
    cut = checkpointed(df.repartitionByRange(parts, order).withColumn("__part", F.spark_partition_id()))
    totals = cut.groupBy("__part").agg(F.count("*").alias("__n"))
    before = totals.select(
        F.col("__part").alias("__p"),
        (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))    # one row per part
    place = F.row_number().over(Window.partitionBy("__part").orderBy(order))
    return (cut.withColumn("__place", place).join(F.broadcast(before), F.col("__part") == F.col("__p"))
            .withColumn(column, (F.col("__before") + F.col("__place")).cast("bigint"))
            .drop("__part", "__p", "__before", "__place"))


def equal_sizes(total: int, parts: int) -> list[int]:
    """Sizes that add up to a total and differ by one at most."""
    return [total // parts + (i < total % parts) for i in range(parts)]
