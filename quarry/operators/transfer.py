"""Transfer learning on precomputed embeddings (inventory D1-D3).

The image featuriser of the reference needs pretrained network weights; the
re-aimed job starts from an embedding column (one vector per item) and
trains the logistic head.  Splits are per class, by key hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame

from quarry.operators.evaluation import multiclass_accuracy
from quarry.operators.shaping import stratified_split


def label_and_split(df: DataFrame, key: str, label: str = "label", weights: Sequence[float] = (0.6, 0.4),
                    seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Split every class by the same fractions and recombine (train, test)."""
    parts = stratified_split(df, list(weights), key, label, seed)
    return parts[0], parts[1]


def embedding_classifier(train: DataFrame, features: str = "features", label: str = "label", max_iter: int = 1,
                         reg: float = 0.05, elastic_net: float = 0.3) -> PipelineModel:
    """Frozen embedding -> logistic head (one iteration, elastic net 0.3)."""
    head = LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter, regParam=reg,
                              elasticNetParam=elastic_net)
    return Pipeline(stages=[head]).fit(train)


def holdout_accuracy(model: PipelineModel, test: DataFrame, label: str = "label") -> DataFrame:
    """Accuracy of the fitted pipeline on held-out rows (one row)."""
    return multiclass_accuracy(model.transform(test), "prediction", label)
