"""Mix sources to target weights: block quotas dealt over output shards by a hypergeometric splitting tree."""

from __future__ import annotations

import random
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import checkpointed, equal_sizes, name, numbered, small_table, with_lookup
from tabprep.llm.draws import splitting_tree

COLOURS = 256


def source_targets(rows: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """Per source: rows, size and target size.

    Sources in code point order, null last, take the weights in turn and share the size of everything. A target
    above ``cap`` times the size of its source stops there, and the excess is shared by weight among the others
    until none is above. Each round is one small aggregate and stops at least one more source.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    turns = numbered(sums, F.col("source").asc_nulls_last(), "turn")
    weight = F.element_at(F.lit(list(weights)), (F.pmod(F.col("turn") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = checkpointed(turns.withColumn("weight", weight.cast("bigint")))
    most = F.col("source_size") * F.lit(cap)
    total, free = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    each, total = (total or 0) / (free or 1), total or 0
    while True:
        above = F.col("weight") * F.lit(each) > most
        stopped, free = sources.agg(F.sum(F.when(above, most).otherwise(F.lit(0))), F.sum(F.when(~above, F.col("weight")))).first()
        again = (total - (stopped or 0)) / free if free else each
        if again <= each:
            break
        each = again
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(float(each)), most.cast("double")))


def mix(
    docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3, n_shards: int = 8, seed: int = 23,
    block_rows: int = 64, max_blocks: int = 4096, keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document with ``source_size``, ``target`` and ``shards``: the output shard of each of its copies.

    ``docs`` has doc_id, source and size. The documents of a source fall into blocks of about ``block_rows`` by
    hash, ``max_blocks`` at most, so a block of the largest source is a bounded part of it. A source whose target
    is k times its size plus a rest gives every block k times, and blocks in random order for the rest. The last
    of these gives the documents that still fit, in random order, and then its smallest ones up to the nearest sum. The blocks of each source are its quota. Halving the
    shards again and again, a multivariate hypergeometric draw gives each half its exact quota of each source;
    the permuted blocks of the source are then dealt out along these numbers, so no block serves twice. Sources
    beyond 256 share their draw with others, and the permutation of their blocks makes the rest of it.

    The same rows give the same mix; columns in ``keep`` are carried along and break ties. Null sources are one source, null sizes count as 0 and are never taken,
    repeated rows are taken one by one, and an empty table gives an empty table.
    """
    spark = docs.sparkSession
    rows = checkpointed(docs.select(
        "doc_id", "source", F.coalesce(F.col("size"), F.lit(0)).cast("bigint").alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", "size").alias("__hash"), *[name(c) for c in keep]))
    sources = source_targets(rows, weights, cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    sources = checkpointed(sources.withColumn("whole", whole).select(
        "source", "source_size", "target", "whole",
        (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"),
        F.pmod(F.col("turn") - 1, F.lit(COLOURS)).cast("int").alias("colour"),
        F.least(F.ceil(F.col("source_rows") / block_rows), F.lit(max_blocks)).cast("bigint").alias("n_blocks")))
    placed = with_lookup(rows, sources, "source", F.col("__hash")).withColumn(
        "block", F.pmod(F.xxhash64(F.lit(seed + 1), "__hash"), F.col("n_blocks")))

    blocks = placed.groupBy("source", "block").agg(
        F.sum("size").alias("held"), *[F.first(c).alias(c) for c in ("whole", "rest", "colour")])
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 2), "source", "block"), "block")
    before = F.sum("held").over(order) - F.col("held")
    blocks = checkpointed(blocks.withColumn("room", F.col("rest") - before).withColumn(
        "units", F.col("whole") + F.when((F.col("room") > 0) & (F.col("held") > 0), F.lit(1)).otherwise(F.lit(0))))
    quotas = {r["colour"]: r["n"] for r in blocks.groupBy("colour").agg(F.sum("units").alias("n")).collect()}
    held = [quotas.get(c, 0) or 0 for c in range(COLOURS)]
    tree = splitting_tree(random.Random(seed), held, equal_sizes(sum(held), n_shards))
    plan = small_table(
        spark, [{"__c": c, "__ends": list(accumulate(part[c] for part in tree))} for c in range(COLOURS) if held[c]],
        "__c int, __ends array<bigint>")
    drawn = Window.partitionBy("colour").orderBy(F.xxhash64(F.lit(seed + 3), "source", "block", "unit"), "source", "block", "unit")
    dealt = (
        blocks.filter(F.col("units") > 0)
        .select("source", "block", "colour", F.explode(F.sequence(F.lit(1), F.col("units"))).alias("unit"))
        .withColumn("__rank", F.row_number().over(drawn))
        .join(F.broadcast(plan), F.col("colour") == F.col("__c"))
        .withColumn("shard", F.size(F.filter("__ends", lambda end: end < F.col("__rank"))))
        .groupBy("source", "block").agg(F.array_sort(F.collect_list(F.struct("unit", "shard"))).alias("dealt")))
    same = F.col("b.source").eqNullSafe(F.col("d.source")) & (F.col("b.block") == F.col("d.block"))
    blocks = blocks.alias("b").join(dealt.alias("d"), same, "left").select(
        F.col("b.source").alias("__source"), F.col("b.block").alias("__block"), "room", F.col("d.dealt.shard").alias("dealt"))

    block = Window.partitionBy("source", "block")
    at_random = block.orderBy(F.xxhash64(F.lit(seed + 4), "__hash"), "doc_id", "size", *[name(c) for c in keep])
    small_first = block.orderBy("__fits", "size", F.xxhash64(F.lit(seed + 4), "__hash"), "doc_id", *[name(c) for c in keep])
    running = Window.unboundedPreceding, Window.currentRow
    same = F.col("source").eqNullSafe(F.col("__source")) & (F.col("block") == F.col("__block"))
    reached = (
        placed.join(blocks, same, "left")
        .withColumn("__fits", F.sum("size").over(at_random.rowsBetween(*running)) <= F.col("room"))
        .withColumn("__left", F.col("room") - F.sum(F.when(F.col("__fits"), F.col("size")).otherwise(F.lit(0))).over(block))
        .withColumn("__before", F.sum("size").over(small_first.rowsBetween(*running)) - F.col("size")))
    nearer = 2 * (F.col("__left") - F.col("__before")) > F.col("size")              # than without it
    extra = (F.col("__fits") | nearer).cast("int")
    copies = F.when(F.col("size") > 0, F.least(F.col("whole") + extra, F.size("dealt"))).otherwise(F.lit(0))
    shards = F.slice(F.coalesce("dealt", F.array().cast("array<int>")), F.lit(1), F.greatest(copies, F.lit(0)))
    return reached.select("doc_id", "source", "size", "source_size", "target", *[name(c) for c in keep], shards.alias("shards"))


def emit(mixed: DataFrame, seed: int = 29) -> DataFrame:
    """One row per copy with ``mix_shard`` and ``mix_order``, the random place by which a shard is read."""
    copies = mixed.select(*[name(c) for c in mixed.columns if c != "shards"], F.posexplode("shards").alias("copy", "mix_shard"))
    return copies.withColumn("mix_order", F.xxhash64(F.lit(seed), "doc_id", "copy"))
