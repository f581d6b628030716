"""From raw documents to training shards: five stages, each a table of documents written before the next reads it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm.common import BROADCAST_BYTES, body, name, words
from tabprep.llm.decontaminate import contamination
from tabprep.llm.jaccard import jaccard_classes
from tabprep.llm.mix import mix
from tabprep.llm.quality import judge
from tabprep.llm.queries import sharded, table
from tabprep.session import shared_dir

ORACLE_SQL = None            # random block draws and component search have no SQL; tests compare with brute force


def _small(ids: DataFrame, row_bytes: int = 64) -> DataFrame:
    """Broadcast a table of ids if its counted size is below the bound."""
    return F.broadcast(ids) if ids.count() * row_bytes <= BROADCAST_BYTES else ids


def _identified(docs: DataFrame) -> DataFrame:
    """With two hashes of the whole row: equal rows, which alone share them, stand for each other."""
    every = [name(c) for c in docs.columns] + [name(c).isNull() for c in docs.columns]        # a hash passes over nulls
    return docs.withColumns({"__a": F.xxhash64(F.lit(1), *every), "__b": F.xxhash64(F.lit(2), *every)})


def _once(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """One row of each group of equal ones; only rows of the ``repeated`` hashes are moved."""
    repeated = _small(repeated.persist())
    alone = rows.join(repeated, ["__a", "__b"], "left_anti")
    return alone.unionByName(rows.join(repeated, ["__a", "__b"], "left_semi").dropDuplicates(["__a", "__b"]))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and lie near the profile of their language."""
    return judge(docs).filter("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that is linked by 0.8 or more of its 5-word shingles: that with the least id, null
    being the largest, and of several rows with this id one by hash."""
    rows = _identified(docs)
    key = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "__a", "__b")
    classes = jaccard_classes(rows.select(key.alias("__key"), "text"), "__key").persist()
    copies = classes.filter("component_id < __key").select("__key.__a", "__key.__b").distinct()
    repeated = classes.filter("n_shingles > 0").groupBy("__key.__a", "__key.__b").count().filter("count > 1").drop("count")
    return _once(rows.join(_small(copies.persist()), ["__a", "__b"], "left_anti"), repeated).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return contamination(docs, table(spark, sf_dir, "benchmark")).filter("not contaminated").select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them. Equal rows are counted together, and one of them is repeated."""
    rows = _identified(docs)
    sized = rows.select("doc_id", "source", F.size(words(body())).cast("bigint").alias("size"), "__a", "__b")
    taken = mix(sized, keep=("__a", "__b")).groupBy("__a", "__b").agg(
        F.count("*").alias("__rows"), F.sum(F.size("shards")).alias("__copies")).filter("__copies > 0").persist()
    once = _once(rows, taken.filter("__rows > 1").select("__a", "__b"))
    copied = once.join(_small(taken.drop("__rows")), ["__a", "__b"])
    return copied.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).select(*[name(c) for c in docs.columns])


def exact_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document of the mix."""
    return sharded(docs)


STAGES = [
    ("quality_rules", quality_rules), ("ngram_jaccard_join", near_duplicates), ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix), ("exact_shards", exact_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for label, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{label}")
        docs = spark.read.parquet(f"{folder}/{label}")
    return STAGES[-1][1](spark, docs, sf_dir)
