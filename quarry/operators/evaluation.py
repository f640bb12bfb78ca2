"""Evaluation (inventory E1-E4, M1b, R1b) as DataFrame aggregations.

Binary metrics are exact: scores are grouped, ranked with distributed
running sums (no single-partition sort), and each score group contributes
its trapezoid to one global sum.  Regression metrics are one aggregation
over the scored rows; no RDD detour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.shaping import sums_by_value


def binary_metrics(df: DataFrame, score: str = "rawPrediction", label: str = "label") -> DataFrame:
    """One row: ``areaUnderROC``, ``areaUnderPR``, exact (every distinct
    score is a threshold; ties form one step).  A vector score uses its
    last element (the positive-class score).  An area that needs a class
    which has no row is null."""
    dtype = type(df.schema[score].dataType).__name__
    if dtype == "VectorUDT":
        from pyspark.ml.functions import vector_to_array

        s = F.element_at(vector_to_array(F.col(score)), -1)
    else:
        s = F.col(score).cast("double")
    groups = df.select(s.alias("s"), (F.col(label).cast("double") > 0.5).cast("long").alias("y")).groupBy("s").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")
    )
    ranked = sums_by_value(groups, "s", {"tp": "pos", "fp": "neg"}, descending=True)
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    prec = tp / (tp + fp)
    prec0 = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(prec)
    # areas in counts; the totals are the last running sums, so one pass does
    sums = ranked.agg(
        F.sum((fp - fp0) * (tp + tp0) / 2.0).alias("roc"), F.sum((tp - tp0) * (prec + prec0) / 2.0).alias("pr"),
        F.max(tp).alias("p"), F.max(fp).alias("n"),
    )
    return sums.select(
        F.try_divide("roc", F.col("p") * F.col("n")).alias("areaUnderROC"), F.try_divide("pr", "p").alias("areaUnderPR")
    )


def multiclass_accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row: ``accuracy`` (share of exact matches) and ``n``."""
    hit = (F.col(prediction).cast("double") == F.col(label).cast("double")).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def rmse(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row: root mean squared error."""
    err = F.col(prediction).cast("double") - F.col(label).cast("double")
    return df.agg(F.sqrt(F.avg(err * err)).alias("rmse"))


def regression_metrics(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row: ``mse, rmse, r2, mae, explained_variance, n``.  Explained
    variance is ``mean((prediction - mean(label))^2)``; ``r2`` of a constant
    label is null."""
    p, y = F.col(prediction).cast("double"), F.col(label).cast("double")
    err = p - y
    # sums of squares around the label mean follow from the moments of the same pass
    stats = df.agg(
        F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"), F.var_pop(y).alias("var_y"),
        (F.var_pop(p) + (F.avg(p) - F.avg(y)) * (F.avg(p) - F.avg(y))).alias("explained_variance"),
        F.count(F.lit(1)).alias("n"),
    )
    return stats.select(
        "mse",
        F.sqrt("mse").alias("rmse"),
        (1 - F.try_divide("mse", "var_y")).alias("r2"),
        "mae",
        "explained_variance",
        "n",
    )


def curve_points(scored: DataFrame, score: str, label: str) -> DataFrame:
    """ROC and precision-recall points, one row per distinct score, from the highest: ``threshold, tp, fp, tpr, fpr,
    precision`` of calling every row at or above the threshold positive.

    Rows are counted per score first; running counts come from range partitions (``sums_by_value``), so neither a score
    that holds a third of all rows nor the whole curve meets in one task.  Rows without score or label are left out; a
    rate without rows to divide by is null."""
    rows = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    positive = (F.col(label) > 0).cast("long")
    counts = rows.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(positive).alias("__pos"), F.sum(1 - positive).alias("__neg"))
    summed = sums_by_value(counts, "threshold", {"tp": "__pos", "fp": "__neg"}, descending=True).checkpoint()
    total = summed.agg(F.max("tp").alias("p"), F.max("fp").alias("n")).first()
    rate = lambda c, n: F.try_divide(F.col(c).cast("double"), F.lit(n).cast("double"))
    return summed.select(
        "threshold", "tp", "fp", rate("tp", total["p"]).alias("tpr"), rate("fp", total["n"]).alias("fpr"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"))


def training_curves(model) -> dict:
    """ROC and PR points, area under ROC, objective history and scored training
    rows of a binary logistic regression fit, as DataFrames / numbers.  Points
    are binned by the fit; ``curve_points`` of the scored rows has them all."""
    s = model.summary
    return {
        "roc": s.roc,
        "pr": s.pr,
        "areaUnderROC": s.areaUnderROC,
        "objectiveHistory": list(s.objectiveHistory),
        "scored": s.predictions,
    }


def regression_summary(model) -> dict:
    """Residuals (DataFrame), iterations, objective history, RMSE and R^2 of a linear fit."""
    s = model.summary
    return {
        "residuals": s.residuals,
        "totalIterations": s.totalIterations,
        "objectiveHistory": list(s.objectiveHistory),
        "rootMeanSquaredError": s.rootMeanSquaredError,
        "r2": s.r2,
        "numInstances": s.numInstances,
    }
