"""Classification and regression (inventory M1-M5, R1-R5).

Each function fits an MLlib estimator with the reference's settings as
defaults, named columns and a fixed seed; fitting itself (L-BFGS, IRLS,
tree growing) is MLlib's distributed code.  Model parameters that are a few
numbers per class or feature come back as small DataFrames.
"""

from __future__ import annotations

from pyspark.ml import classification as MC
from pyspark.ml import regression as MR
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def logistic_regression(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    max_iter: int = 100,
    reg: float = 0.0,
    elastic_net: float = 0.0,
    family: str = "auto",
    tol: float = 1e-6,
    **kw,
) -> MC.LogisticRegressionModel:
    return MC.LogisticRegression(
        featuresCol=features, labelCol=label, maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net,
        family=family, tol=tol, **kw,
    ).fit(df)


def coefficient_table(spark: SparkSession, model) -> DataFrame:
    """``(term, value)``: intercept(s) and coefficients of a linear model."""
    rows = []
    if hasattr(model, "coefficientMatrix") and getattr(model, "numClasses", 2) > 2:
        m = model.coefficientMatrix.toArray()
        for c in range(m.shape[0]):
            rows.append((f"intercept_{c}", float(model.interceptVector[c])))
            rows += [(f"coef_{c}_{j}", float(v)) for j, v in enumerate(m[c])]
    else:
        rows.append(("intercept", float(model.intercept)))
        rows += [(f"coef_{j}", float(v)) for j, v in enumerate(model.coefficients.toArray())]
    return spark.createDataFrame(rows, "term string, value double")


def decision_tree_classifier(df: DataFrame, features="features", label="label", max_depth=5, max_bins=32,
                             impurity="gini", seed=42) -> MC.DecisionTreeClassificationModel:
    return MC.DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=max_depth, maxBins=max_bins,
                                     impurity=impurity, seed=seed).fit(df)


def random_forest_classifier(df: DataFrame, features="features", label="label", num_trees=20, max_depth=5,
                             seed=42) -> MC.RandomForestClassificationModel:
    return MC.RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=num_trees, maxDepth=max_depth,
                                     seed=seed).fit(df)


def gbt_classifier(df: DataFrame, features="features", label="label", max_iter=20, step=0.1, max_depth=5,
                   seed=42) -> MC.GBTClassificationModel:
    """Gradient-boosted trees, logistic loss, binary labels only."""
    return MC.GBTClassifier(featuresCol=features, labelCol=label, maxIter=max_iter, stepSize=step,
                            maxDepth=max_depth, seed=seed).fit(df)


def naive_bayes(df: DataFrame, features="features", label="label", smoothing=1.0,
                model_type="multinomial", check: bool = True) -> MC.NaiveBayesModel:
    """Multinomial naive Bayes.  Features must be non-negative and at least
    two classes present; ``check`` verifies both with one aggregation."""
    if check:
        from pyspark.ml.functions import vector_to_array

        stats = df.agg(
            F.min(F.array_min(vector_to_array(F.col(features)))).alias("lo"),
            F.countDistinct(F.col(label)).alias("k"),
        ).first()
        if stats["lo"] is not None and stats["lo"] < 0:
            raise ValueError("naive Bayes needs non-negative features")
        if stats["k"] < 2:
            raise ValueError("naive Bayes needs at least two classes")
    return MC.NaiveBayes(featuresCol=features, labelCol=label, smoothing=smoothing, modelType=model_type).fit(df)


def naive_bayes_params(spark: SparkSession, model: MC.NaiveBayesModel) -> DataFrame:
    """``(kind, label, feature, value)``: log priors (kind 'pi', feature -1)
    and log conditional probabilities (kind 'theta')."""
    rows = [("pi", float(c), -1, float(v)) for c, v in enumerate(model.pi.toArray())]
    th = model.theta.toArray()
    for c in range(th.shape[0]):
        rows += [("theta", float(c), j, float(v)) for j, v in enumerate(th[c])]
    return spark.createDataFrame(rows, "kind string, label double, feature int, value double")


def linear_regression(df: DataFrame, features="features", label="label", max_iter=10, reg=0.3,
                      elastic_net=0.8, solver="auto", **kw) -> MR.LinearRegressionModel:
    """Linear regression; features are standardised internally."""
    return MR.LinearRegression(featuresCol=features, labelCol=label, maxIter=max_iter, regParam=reg,
                               elasticNetParam=elastic_net, solver=solver, **kw).fit(df)


def glm(df: DataFrame, features="features", label="label", family="gaussian", link="identity", max_iter=10,
        reg=0.3, link_prediction="linkOut") -> MR.GeneralizedLinearRegressionModel:
    return MR.GeneralizedLinearRegression(featuresCol=features, labelCol=label, family=family, link=link,
                                          maxIter=max_iter, regParam=reg,
                                          linkPredictionCol=link_prediction).fit(df)


def decision_tree_regressor(df: DataFrame, features="features", label="label", max_depth=5,
                            seed=42) -> MR.DecisionTreeRegressionModel:
    return MR.DecisionTreeRegressor(featuresCol=features, labelCol=label, maxDepth=max_depth, seed=seed).fit(df)


def random_forest_regressor(df: DataFrame, features="features", label="label", num_trees=20,
                            seed=42) -> MR.RandomForestRegressionModel:
    return MR.RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=num_trees, seed=seed).fit(df)


def gbt_regressor(df: DataFrame, features="features", label="label", max_iter=20,
                  seed=42) -> MR.GBTRegressionModel:
    """Gradient-boosted trees, squared loss."""
    return MR.GBTRegressor(featuresCol=features, labelCol=label, maxIter=max_iter, seed=seed).fit(df)


def scored_invariants(scored: DataFrame, label: str = "label", num_classes: int | None = None,
                      extra: list | None = None) -> DataFrame:
    """Per label: ``n`` rows and ``n_valid`` rows whose prediction is a known
    class and, when present, whose probability vector sums to 1 and peaks at
    the prediction."""
    from pyspark.ml.functions import vector_to_array

    ok = F.col("prediction").isNotNull() & (F.col("prediction") >= 0)
    if num_classes is not None:
        ok = ok & (F.col("prediction") < num_classes)
    if "probability" in scored.columns:
        prob = vector_to_array(F.col("probability"))
        total = F.aggregate(prob, F.lit(0.0), lambda a, b: a + b)
        peak = F.element_at(prob, (F.col("prediction") + 1).cast("int"))
        ok = ok & (F.abs(total - 1.0) < 1e-6) & (peak >= F.array_max(prob) - 1e-12)
    return scored.groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_valid"), *(extra or [])
    )
