"""Isolation forest (Liu, Ting, Zhou 2008): trees grown from small seeded samples, scores from every row."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.operators.quantiles import exact_quantiles
from tabprep.operators.stats import col, one_row

# The tree functions travel with the tasks, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EULER = 0.5772156649015329
FEW_COPIES = 64              # of an equal row, each with a number of its own
NODE_SCHEMA = "tree int, node int, feature int, cut double, depth double"


def expected_depth(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def _drawn_copies(share: float):
    """Of many equal rows, how many are drawn if each is with the same chance: binomial, seeded by a hash of the row."""
    @F.pandas_udf(T.LongType())
    def draw(copies: pd.Series, mark: pd.Series) -> pd.Series:
        return pd.Series([
            0 if np.isnan(n) else int(np.random.default_rng(int(m) & (2 ** 63 - 1)).binomial(int(n), share))
            for n, m in zip(copies.to_numpy(dtype=float), mark)], dtype="int64")

    return draw


def grow_tree(data: np.ndarray, tree: int, limit: int, seed: int) -> pd.DataFrame:
    """Split at random until rows are alone, alike or at the depth limit.

    The tree is a full binary heap of depth ``limit``: node i has the children 2i+1 and 2i+2. Below an early leaf
    every row is sent left, so all rows reach the bottom row, whose nodes carry the expected depth.
    """
    draw = np.random.default_rng([seed, tree])
    size = 2 ** (limit + 1) - 1
    feature, cut, depth = np.zeros(size, dtype=int), np.full(size, np.inf), np.zeros(size)
    todo = [(data, 0, 0)]
    while todo:
        part, node, level = todo.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if level == limit or len(part) <= 1 or len(usable) == 0:
            bottom = (node + 1) * 2 ** (limit - level) - 1
            depth[bottom] = level + expected_depth(len(part))
            continue
        feature[node] = draw.choice(usable)
        cut[node] = draw.uniform(low[feature[node]], high[feature[node]])
        goes_left = part[:, feature[node]] <= cut[node]
        todo.append((part[~goes_left], 2 * node + 2, level + 1))
        todo.append((part[goes_left], 2 * node + 1, level + 1))
    return pd.DataFrame({"tree": tree, "node": np.arange(size), "feature": feature, "cut": cut, "depth": depth})


@dataclass(frozen=True)
class IsolationForestModel:
    columns: tuple[str, ...]
    nodes: pd.DataFrame           # fewer than 4 * sample_rows rows per tree
    sample_rows: int
    contamination: float
    cut: float | None = None

    def score(self) -> Column:
        """The anomaly score of a row in (0, 1], as an expression over the fitted columns."""
        ordered = self.nodes.sort_values(["tree", "node"])
        trees = ordered["tree"].nunique()
        size = len(ordered) // trees
        levels = (size + 1).bit_length() - 2
        feature, cut, depth = [
            ordered[c].to_numpy(dtype=kind).reshape(trees, size)
            for c, kind in (("feature", np.int64), ("cut", float), ("depth", float))
        ]
        scale = expected_depth(self.sample_rows) or 1.0

        @F.pandas_udf(T.DoubleType())
        def forest_score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for batch in batches:
                parts = batch if isinstance(batch, tuple) else (batch,)      # one column comes as a bare series
                values = np.concatenate([s.to_numpy(dtype=float) for s in parts])      # column after column
                rows = np.arange(len(parts[0]))
                total = np.zeros(len(rows))
                for tree in range(trees):
                    column_start = feature[tree] * len(rows)
                    at = np.zeros(len(rows), dtype=np.int64)
                    for _ in range(levels):
                        above = values.take(column_start.take(at) + rows) > cut[tree].take(at)
                        at = 2 * at + 1 + above
                    total += depth[tree].take(at)
                yield pd.Series(np.exp2(-total / trees / scale))

        return forest_score(*[col(c).cast("double") for c in self.columns])

    def keep_inliers(self, df: DataFrame) -> DataFrame:
        """Rows whose score is not above the cut found when fitting."""
        return df.where(self.score() <= F.lit(self.cut))

    def outlier_flags(self, df: DataFrame) -> DataFrame:
        return df.withColumn("score", self.score()).withColumn("outlier", F.col("score") > F.lit(self.cut))


@dataclass(frozen=True)
class IsolationForest:
    """Defaults as in common libraries: 100 trees of 256 rows, a tenth of the rows taken as outliers.

    ``row_key`` names columns that tell rows apart; by default all fitted columns together do.
    """

    trees: int = 100
    sample_rows: int = 256
    contamination: float = 0.1
    seed: int = 42
    row_key: Sequence[str] | None = None

    def _grown(self, df: DataFrame, cols: Sequence[str]) -> IsolationForestModel:
        """The trees, without a cut."""
        counts = one_row(df, {None: F.count(F.lit(1)), **{c: F.count(col(c)) for c in cols}})
        rows = counts.pop(None)
        gaps = [c for c, n in counts.items() if n < rows]
        if gaps:
            raise ValueError(f"an isolation forest takes no nulls, fill these columns first: {gaps}")
        if not rows:
            raise ValueError("an isolation forest cannot be fitted to an empty table")
        size = min(self.sample_rows, rows)
        limit = max(1, math.ceil(math.log2(max(size, 2))))
        seed, names = self.seed, [f"x{i}" for i in range(len(cols))]

        def grow(group: pd.DataFrame) -> pd.DataFrame:
            ordered = group.sort_values(["pick", *names])
            return grow_tree(ordered[names].to_numpy(dtype=float), int(ordered["tree"].iloc[0]), limit, seed)

        nodes = self._samples(df, cols, names, rows, size).groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()
        return IsolationForestModel(tuple(cols), nodes, size, self.contamination)

    def _cut(self, scored: DataFrame) -> float:
        return exact_quantiles(scored, ["score"], [1.0 - self.contamination])["score"][1.0 - self.contamination]

    def fit(self, df: DataFrame, cols: Sequence[str]) -> IsolationForestModel:
        model = self._grown(df, cols)
        scored = df.select(model.score().alias("score")).persist(StorageLevel.MEMORY_AND_DISK)   # one double per row
        try:
            return replace(model, cut=self._cut(scored))
        finally:
            scored.unpersist()

    def fit_flags(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        """The table with ``score`` and ``outlier``, every row scored once.

        The scored table stays in the executors' memory and disk until it is unpersisted, as the cut is a pass of its own.
        """
        scored = df.withColumn("score", self._grown(df, cols).score()).persist(StorageLevel.MEMORY_AND_DISK)
        return scored.withColumn("outlier", F.col("score") > F.lit(self._cut(scored)))

    def fit_keep(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        """The rows that are no outliers among those passed in, which are scored once and kept as in ``fit_flags``."""
        scored = df.withColumn("__score", self._grown(df, cols).score()).persist(StorageLevel.MEMORY_AND_DISK)
        cut = self._cut(scored.select(F.col("__score").alias("score")))
        return scored.where(F.col("__score") <= F.lit(cut)).drop("__score")

    def count_outliers(self, df: DataFrame, cols: Sequence[str]) -> tuple[int, int]:
        """Rows, and those of them that are outliers."""
        scored = df.select(self._grown(df, cols).score().alias("score")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return tuple(scored.agg(F.count("*"), F.count_if(F.col("score") > F.lit(self._cut(scored)))).first())
        finally:
            scored.unpersist()

    def _samples(self, df: DataFrame, cols: Sequence[str], names: Sequence[str], rows: int, size: int) -> DataFrame:
        """``size`` rows per tree, chosen by seeded hash: the same ones however the table is partitioned."""
        values = [col(c).cast("double").alias(n) for c, n in zip(cols, names)]
        if self.row_key:
            hashed = df.select(F.xxhash64(F.lit(self.seed), *[col(k) for k in self.row_key]).alias("pick"), *values)
        else:       # every copy of a repeated row has its own chance, but only those that are likely to be taken are made
            counted = df.select(*values).groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
            wanted = self.trees * size
            share = min(1.0, (wanted + 6 * math.sqrt(wanted) + 20) / rows)
            many = F.col("copies") > FEW_COPIES
            drawn = F.when(many & F.lit(share < 1.0), _drawn_copies(share)(
                F.when(many, F.col("copies")), F.xxhash64(F.lit(self.seed), *names))).otherwise(F.col("copies"))
            some = counted.select(*names, many.alias("many"), drawn.alias("drawn")).where("drawn > 0")
            each = some.select(*names, "many", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("drawn"))).alias("copy"))
            free = F.shiftrightunsigned(F.xxhash64(F.lit(self.seed), *names, "copy"), 11) * (1.0 / (1 << 53))
            hashed = each.select(F.when(F.col("many"), free * share).otherwise(free).alias("pick"), *names).where(F.col("pick") < share)
        lowest = hashed.orderBy("pick", *names).limit(self.trees * size)       # top-k per task, then merged
        if rows >= self.trees * size:
            place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("pick", *names))
            return lowest.withColumn("tree", place % self.trees)
        # A small table: every tree draws its own rows from the same pool.
        each = lowest.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(self.trees - 1))))
        each = each.withColumn("pick", F.xxhash64("tree", "pick", *names))
        place = F.row_number().over(Window.partitionBy("tree").orderBy("pick", *names))
        return each.withColumn("rn", place).where(F.col("rn") <= size).drop("rn")
