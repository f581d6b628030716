"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix."""

from __future__ import annotations

import random
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import checkpointed, equal_sizes, name, small_table
from tabprep.llm.draws import communication_matrix


def shard(
    docs: DataFrame, n_shards: int = 8, key: Sequence[str] = ("doc_id",), seed: int = 11, blocks: int = 1024,
) -> DataFrame:
    """Add ``shard`` (0 to n - 1) and ``slot`` (its place in the shard, gapless from 0) to every row.

    Rows fall into ``blocks`` source blocks by a hash of the key. A count per block gives the row margins, the
    exact shard sizes (one apart at most) the column margins of a matrix, drawn as a uniform shuffle would give
    it. Each block is permuted by a second hash and dealt out along its row of the matrix; inside its shard every
    row gets a new random place. The plan holds ``blocks * n_shards`` numbers whatever the input.

    Windows run inside a block, or inside a block of a shard, so none holds more than about 1 / blocks of the
    rows unless a key repeats that often. Nulls in the key are a value like any other; rows that repeat a key are
    placed one by one; an empty table gives an empty table. Columns called shard or slot are replaced.
    """
    kept = docs.drop("shard", "slot")
    keys = [name(k) for k in key]
    fixed = checkpointed(kept.withColumns({
        "__block": F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(blocks)).cast("int"),
        "__deal": F.xxhash64(F.lit(seed + 1), *keys), "__place": F.xxhash64(F.lit(seed + 2), *keys),
    }))
    counts = {r["__block"]: r["n"] for r in fixed.groupBy("__block").agg(F.count("*").alias("n")).collect()}
    held = [counts.get(b, 0) for b in range(blocks)]
    matrix = communication_matrix(random.Random(seed), held, equal_sizes(sum(held), n_shards))
    plan = small_table(
        docs.sparkSession, [{"__b": b, "__ends": list(accumulate(row))} for b, row in enumerate(matrix) if held[b]],
        "__b int, __ends array<bigint>")
    ties = [name(c) for c, kind in kept.dtypes if not kind.startswith("map") and c not in key]
    dealt = Window.partitionBy("__block").orderBy("__deal", *keys, F.xxhash64(*ties) if ties else F.lit(0))
    sent = checkpointed(
        fixed.join(F.broadcast(plan), F.col("__block") == F.col("__b"))
        .withColumn("__rank", F.row_number().over(dealt))
        .withColumn("shard", F.size(F.filter("__ends", lambda end: end < F.col("__rank"))))
        .withColumn("__bin", F.pmod(F.col("__place"), F.lit(blocks)).cast("int"))
        .drop("__b", "__ends", "__block", "__deal", "__rank"))
    bins = sent.groupBy("shard", "__bin").agg(F.count("*").alias("__n"))
    before = bins.select(
        F.col("shard").alias("__s"), F.col("__bin").alias("__t"),
        (F.sum("__n").over(Window.partitionBy("shard").orderBy("__bin")) - F.col("__n")).alias("__before"))
    place = F.row_number().over(Window.partitionBy("shard", "__bin").orderBy("__place", *keys))
    return (sent.withColumn("__at", place)
            .join(F.broadcast(before), (F.col("shard") == F.col("__s")) & (F.col("__bin") == F.col("__t")))
            .withColumn("slot", F.col("__before") + F.col("__at") - 1)
            .select(*[name(c) for c in kept.columns], "shard", "slot"))
