"""Pipelines, parameter grids and model selection (inventory T1-T4).

Selection runs MLlib's fits, ``parallelism`` grid points at a time.  Cross-validation takes a
fold column built from a key hash, so folds are reproducible and survive
recomputation.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator, Sequence

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame, SparkSession

from quarry.functions.scalar import hash_number


class _SharedFits(Iterator):
    """Fitted pipelines of a grid, with the point each belongs to.  Points whose settings differ in the last stage
    only share one fit of the stages before it, over rows that are transformed and stored once."""

    def __init__(self, stages: Sequence, dataset: DataFrame, maps: Sequence[dict]):
        self.stages, self.dataset, self.maps = stages, dataset, maps
        self.lock, self.next_point = threading.Lock(), 0
        self.groups: dict = {}
        early = {s.uid for s in stages[:-1]}
        self.keys = [frozenset((p, repr(v)) for p, v in m.items() if p.parent in early) for m in maps]

    def __next__(self):
        with self.lock:
            point = self.next_point
            if point >= len(self.maps):
                raise StopIteration
            self.next_point += 1
            group = self.groups.setdefault(self.keys[point], {"lock": threading.Lock(), "left": self.keys.count(self.keys[point])})
        chosen = self.maps[point]
        with group["lock"]:
            if "rows" not in group:
                before = Pipeline(stages=list(self.stages[:-1])).fit(self.dataset, chosen)
                group["stages"], group["rows"] = before.stages, before.transform(self.dataset).persist(StorageLevel.MEMORY_AND_DISK)
        last = self.stages[-1].copy(chosen)
        fitted = last if isinstance(last, Transformer) else last.fit(group["rows"])
        with group["lock"]:
            group["left"] -= 1
            if not group["left"]:
                group["rows"].unpersist()
        return point, PipelineModel([*group["stages"], fitted])


class SharedPipeline(Pipeline):
    """A pipeline that fits the stages before the last once for all grid points that set them alike."""

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[dict]) -> Iterator:  # noqa: N802, N803
        stages = self.getStages()
        own = {self.uid, *(s.uid for s in stages)}
        simple = len(stages) > 1 and all(isinstance(s, Estimator | Transformer) and not isinstance(s, Pipeline) for s in stages)
        if not simple or any(p.parent not in own or p.parent == self.uid for m in paramMaps for p in m):
            return super().fitMultiple(dataset, paramMaps)
        return _SharedFits(stages, dataset, paramMaps)


def pipeline(stages: Sequence) -> Pipeline:
    """Ordered stages fitted and applied in turn; over a grid, see ``SharedPipeline``."""
    return SharedPipeline(stages=list(stages))


def param_grid(axes: Sequence[tuple[object, Sequence]]) -> list:
    """Cartesian grid of ``(param, values)`` axes (2 x 3 x 2 = 12 maps)."""
    b = ParamGridBuilder()
    for param, values in axes:
        b = b.addGrid(param, list(values))
    return b.build()


def grid_table(spark: SparkSession, grid: list) -> DataFrame:
    """One row per grid point: ``(point, param, value)`` as text."""
    rows = [(i, p.name, str(v)) for i, pm in enumerate(grid) for p, v in pm.items()]
    return spark.createDataFrame(rows, "point int, param string, value string")


def train_validation_split(estimator, grid: list, evaluator, df: DataFrame, train_ratio: float = 0.75,
                           seed: int = 42, parallelism: int = 8):
    """Fit every grid point on ``train_ratio`` of the rows, keep the best by
    the evaluator, refit it on all rows."""
    tvs = TrainValidationSplit(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator,
                               trainRatio=train_ratio, seed=seed, parallelism=parallelism)
    return tvs.fit(df)


def fold_column(df: DataFrame, key: str | Column, folds: int, seed: int = 0, name: str = "fold") -> DataFrame:
    """Deterministic fold id ``0..folds-1`` from a hash of ``key``."""
    return df.withColumn(name, (hash_number(key, seed) % folds).cast("int"))


def cross_validate(estimator, grid: list, evaluator, df: DataFrame, folds: int = 3, fold_col: str | None = None,
                   seed: int = 42, parallelism: int = 8):
    """k-fold cross-validation; the metric is averaged per grid point."""
    kw = {"foldCol": fold_col} if fold_col else {}
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds,
                        seed=seed, parallelism=parallelism, **kw)
    return cv.fit(df)
