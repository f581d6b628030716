"""The whole way from a loaded table to a scored linear model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.operators.impute import Imputer, ImputerModel
from tabprep.operators.outliers import handle_outliers
from tabprep.operators.regress import LinearModel, feature_columns, fit_linear, metric_exprs
from tabprep.operators.roles import abs_numeric, drop_columns
from tabprep.operators.scale import Scaler, ScalerModel
from tabprep.operators.split import split_hash
from tabprep.operators.stats import col


@dataclass(frozen=True)
class TrainedFlow:
    """Everything fitted on the training part, ready for new data."""

    label: str
    imputer: ImputerModel
    scaler: ScalerModel
    model: LinearModel

    def prepare(self, df: DataFrame) -> DataFrame:
        """Literal projections only: no statistic is taken from the new data."""
        return self.scaler.transform(self.imputer.transform(df))

    def predict(self, df: DataFrame) -> DataFrame:
        return self.model.predict(self.prepare(df))


@dataclass(frozen=True)
class RegressionFlow:
    """Drop, absolute values, split, then impute, cut outliers and scale with training statistics, fit and score.

    The label takes no part in imputing, outliers and scaling; ``impute_label`` fills it like a feature.
    """

    label: str
    key: Sequence[str]
    drop: Sequence[str] = ()
    absolute: bool = True
    test_size: float = 0.2
    seed: int = 42
    imputer: Imputer = field(default_factory=lambda: Imputer(num_strategy="median"))
    impute_label: bool = False
    outlier_method: str | None = "iqr"
    outlier_strategy: str = "drop"
    outlier_exclude: Sequence[str] = ()
    scaling: str = "standard"
    keep_key: bool = False
    cache: bool = True            # hold the training part, which every fit below reads

    def fit(self, df: DataFrame) -> tuple[TrainedFlow, int, DataFrame]:
        """The fitted flow, the number of training rows left after the outlier step, and the prepared test part."""
        train, test = split_hash(df, self.key, self.test_size, self.seed)
        train, test = self._clean(train), self._clean(test)
        ignore = () if self.impute_label else (self.label,)
        settings = {**vars(self.imputer), "exclude": (*self.imputer.exclude, *ignore)}
        if self.cache:
            train = train.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            imputer = Imputer(**settings).fit(train)
            ready = imputer.transform(train)
            if self.outlier_method:
                ready = handle_outliers(
                    ready, self.outlier_method, self.outlier_strategy, (*self.outlier_exclude, self.label))
            scaler = Scaler(self.scaling, (self.label,)).fit(ready)
            scaled = scaler.transform(ready)
            rows = scaled.count()
            model = fit_linear(scaled, self.label, feature_columns(scaled, self.label))
        finally:
            if self.cache:
                train.unpersist()
        flow = TrainedFlow(self.label, imputer, scaler, model)
        return flow, rows, flow.prepare(test)

    def _clean(self, df: DataFrame) -> DataFrame:
        hidden = () if self.keep_key else self.key
        out = drop_columns(df, [*self.drop, *hidden])
        return abs_numeric(out) if self.absolute else out

    def run(self, df: DataFrame) -> DataFrame:
        """One row ``(n_train, n_test, mse, r2, mae)``; train rows are those left after the outlier step."""
        flow, rows, test = self.fit(df)
        scored = flow.model.predict(test)
        parts = metric_exprs(col(self.label), F.col("prediction"))
        return scored.agg(
            F.lit(rows).cast("bigint").alias("n_train"), F.count(F.lit(1)).alias("n_test"),
            *[parts[m].alias(m) for m in ("mse", "r2", "mae")])
