"""Random search over forest parameters with cross-validation and median pruning."""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from statistics import median

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.operators.regress import (
    ForestParams, assemble, fit_forest, metric_exprs, params_row, regression_metrics,
)
from tabprep.operators.split import assign_folds
from tabprep.operators.stats import col

STARTUP_TRIALS = 5


@dataclass(frozen=True)
class Space:
    """Ranges to draw from, both ends included. Spark grows trees to depth 30 at most."""

    trees: tuple[int, int, int] = (100, 1000, 100)
    max_depth: tuple[int, int] = (5, 30)
    min_leaf: tuple[int, int] = (1, 10)
    feature_share: tuple[float, float, float] = (0.2, 1.0, 0.1)

    def draw(self, count: int, seed: int) -> list[ForestParams]:
        rng = random.Random(seed)
        low, high, step = self.feature_share
        return [
            ForestParams(
                trees=rng.randrange(self.trees[0], self.trees[1] + 1, self.trees[2]),
                max_depth=rng.randint(*self.max_depth),
                min_leaf=rng.randint(*self.min_leaf),
                feature_share=round(low + step * rng.randint(0, round((high - low) / step)), 10),
                seed=seed,
            ) for _ in range(count)
        ]


@dataclass(frozen=True)
class Trial:
    number: int
    params: ForestParams
    fold_mse: tuple[float, ...]
    pruned: bool

    @property
    def value(self) -> float:
        return sum(self.fold_mse) / len(self.fold_mse)

    def running(self) -> list[float]:
        return [sum(self.fold_mse[:i]) / i for i in range(1, len(self.fold_mse) + 1)]


@dataclass(frozen=True)
class Search:
    trials: tuple[Trial, ...]

    @property
    def best(self) -> Trial:
        """The finished trial with the lowest value, the earliest on a tie."""
        return min((t for t in self.trials if not t.pruned), key=lambda t: (t.value, t.number))

    def table(self, like: DataFrame) -> DataFrame:
        """One row per trial and fold."""
        rows = [
            (t.number, step, mse, mean, t.pruned, *params_row(t.params).values())
            for t in self.trials for step, (mse, mean) in enumerate(zip(t.fold_mse, t.running()), 1)
        ]
        return like.sparkSession.createDataFrame(
            rows, "trial int, step int, mse double, running_mean double, pruned boolean, trees int, max_depth int, "
                  "min_leaf int, feature_share double")


def forest_fold_mse(table: DataFrame, label: str, fold: int, params: ForestParams) -> float:
    """Fit on all other folds, score on this one."""
    model = fit_forest(table.where(F.col("fold") != fold), label, params)
    scored = model.transform(table.where(F.col("fold") == fold))
    return scored.agg(metric_exprs(col(label), F.col("prediction"))["mse"]).first()[0]


def should_prune(running: Sequence[float], finished: Sequence[Sequence[float]], startup: int = STARTUP_TRIALS) -> bool:
    """Whether the best running mean so far is worse than the median of finished trials at the same step."""
    if len(finished) < startup:
        return False
    step = len(running) - 1
    peers = [r[step] for r in finished if len(r) > step]
    return bool(peers) and min(running) > median(peers)


def search_forest(
    df: DataFrame, label: str, features: Sequence[str], key: Sequence[str], trials: int = 50, folds: int = 5,
    seed: int = 42, parallelism: int = 4, space: Space | None = None, startup: int = STARTUP_TRIALS,
) -> Search:
    """Minimise the cross-validated MSE of a random forest.

    Trials run in waves of ``parallelism`` threads, each of which submits distributed fits over one cached table.
    A trial is compared with the trials of earlier waves only, so the outcome does not depend on timing.
    """
    labelled = assign_folds(df.dropna(subset=[label]), key, folds, seed).withColumn("__label", col(label).cast("double"))
    table = assemble(labelled, features, ["fold", "__label"]).withColumnRenamed("__label", "label")
    table = table.persist(StorageLevel.MEMORY_AND_DISK)
    done: list[Trial] = []
    candidates = list(enumerate((space or Space()).draw(trials, seed)))

    def run(number: int, params: ForestParams, finished: list[list[float]]) -> Trial:
        scores: list[float] = []
        for fold in range(folds):
            scores.append(forest_fold_mse(table, "label", fold, params))
            means = Trial(number, params, tuple(scores), False).running()
            if fold < folds - 1 and should_prune(means, finished, startup):
                return Trial(number, params, tuple(scores), True)
        return Trial(number, params, tuple(scores), False)

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            for start in range(0, len(candidates), parallelism):
                finished = [t.running() for t in done if not t.pruned]
                wave: Callable[..., Trial] = inheritable_thread_target(df.sparkSession)(run)
                jobs = [pool.submit(wave, n, p, finished) for n, p in candidates[start:start + parallelism]]
                done.extend(j.result() for j in jobs)
    finally:
        table.unpersist()
    return Search(tuple(done))


def refit_best(df: DataFrame, label: str, features: Sequence[str], search: Search) -> tuple[object, DataFrame]:
    """The best parameters fitted to all rows, and the in-sample metrics."""
    labelled = df.dropna(subset=[label]).withColumn("__label", col(label).cast("double"))
    table = assemble(labelled, features, ["__label"])
    model = fit_forest(table, "__label", search.best.params)
    return model, regression_metrics(model.transform(table), "__label")


def median_prune(reports: DataFrame, startup: int = STARTUP_TRIALS) -> DataFrame:
    """The pruning rule over a whole table ``(trial, step, running_mean)``, one row per trial and step.

    Each trial's best value up to a step is set against the median at that step of the trials numbered below it.
    """
    so_far = Window.partitionBy("trial").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("step").orderBy("trial").rowsBetween(Window.unboundedPreceding, -1)
    marked = reports.select(
        "trial", "step", "running_mean", F.min("running_mean").over(so_far).alias("best"),
        F.count(F.lit(1)).over(earlier).alias("peers"),
        F.percentile("running_mean", 0.5).over(earlier).alias("peer_median"),
    )
    return marked.withColumn(
        "prune", (F.col("peers") >= startup) & F.coalesce(F.col("best") > F.col("peer_median"), F.lit(False)))
