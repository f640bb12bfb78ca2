"""Clustering and topics (inventory U1-U4, plus Lloyd iterations with given
centres).

MLlib fits k-means, bisecting k-means, Gaussian mixtures and LDA.  ``lloyd``
runs k-means steps from centres the caller supplies, as plain DataFrame
work: the k centres (k x d numbers, bounded by k) are literals inside one
projection that picks the nearest centre per row, and new centres are one
grouped average.  No join, no cross product of points and centres.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import clustering as MK
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_array(df: DataFrame, col: str) -> Column:
    if type(df.schema[col].dataType).__name__ == "VectorUDT":
        return vector_to_array(F.col(col))
    return F.col(col).cast("array<double>")


def nearest_center(x: Column, centers: Sequence[tuple[int, Sequence[float]]]) -> Column:
    """Id of the centre with the smallest squared distance (ties: smallest id)."""
    cands = []
    for cid, c in centers:
        w = F.array(*[F.lit(float(v)) for v in c])
        d = F.aggregate(F.zip_with(x, w, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v)
        cands.append(F.struct(d.alias("d"), F.lit(int(cid)).alias("c")))
    return F.array_min(F.array(*cands)).getField("c")


def lloyd(
    df: DataFrame,
    features: str,
    centers: DataFrame,
    max_iter: int = 5,
    center_id: str = "cluster",
    center_features: str = "center",
    keep: Sequence[str] = (),
):
    """Lloyd's k-means steps from given centres ``(center_id, center_features)``.

    Returns ``(assignments, centres)``: rows with ``cluster`` assigned by the
    final centres, and the final centres as ``(cluster, pos, value)``.  A
    centre that receives no points keeps its position.
    """
    pts = df.select(*keep, _as_array(df, features).alias("__x")).persist()
    cur = {
        int(r[0]): [float(v) for v in r[1]]
        for r in centers.select(F.col(center_id), _as_array(centers, center_features)).collect()
    }
    try:
        for _ in range(max_iter):
            assigned = pts.select(nearest_center(F.col("__x"), sorted(cur.items())).alias("__c"), "__x")
            means = (
                assigned.select("__c", F.posexplode("__x").alias("pos", "v"))
                .groupBy("__c", "pos")
                .agg(F.avg("v").alias("m"))
                .collect()
            )
            new: dict[int, dict[int, float]] = {}
            for r in means:
                new.setdefault(int(r["__c"]), {})[int(r["pos"])] = float(r["m"])
            for cid, vals in new.items():
                cur[cid] = [vals[i] for i in range(len(vals))]
        out = pts.select(*keep, nearest_center(F.col("__x"), sorted(cur.items())).alias("cluster"))
        spark = df.sparkSession
        table = spark.createDataFrame(
            [(cid, i, v) for cid, c in sorted(cur.items()) for i, v in enumerate(c)], "cluster int, pos int, value double"
        )
        return out.checkpoint(), table
    finally:
        pts.unpersist()


def kmeans(df: DataFrame, features: str = "features", k: int = 5, max_iter: int = 20, seed: int = 42) -> MK.KMeansModel:
    """k-means with k-means|| initialisation."""
    return MK.KMeans(featuresCol=features, k=k, maxIter=max_iter, seed=seed).fit(df)


def bisecting_kmeans(df: DataFrame, features: str = "features", k: int = 5, max_iter: int = 5,
                     seed: int = 42) -> MK.BisectingKMeansModel:
    """Top-down (divisive) k-means."""
    return MK.BisectingKMeans(featuresCol=features, k=k, maxIter=max_iter, seed=seed).fit(df)


def gaussian_mixture(df: DataFrame, features: str = "features", k: int = 5, seed: int = 42,
                     max_iter: int = 100) -> MK.GaussianMixtureModel:
    """Gaussian mixture (EM): weights, means, covariances, probabilities."""
    return MK.GaussianMixture(featuresCol=features, k=k, seed=seed, maxIter=max_iter).fit(df)


def lda(df: DataFrame, features: str = "features", k: int = 10, max_iter: int = 5, seed: int = 42) -> MK.LDAModel:
    """Latent Dirichlet allocation (online optimiser)."""
    return MK.LDA(featuresCol=features, k=k, maxIter=max_iter, seed=seed).fit(df)


def topic_terms(model: MK.LDAModel, vocabulary: DataFrame, n_terms: int = 3) -> DataFrame:
    """``(topic, rank, term, weight)``: top terms per topic joined back to the
    vocabulary table ``(index, term)``."""
    topics = model.describeTopics(n_terms).select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "tw")
    )
    flat = topics.select("topic", "rank", F.col("tw.termIndices").alias("index"), F.col("tw.termWeights").alias("weight"))
    vocab = vocabulary.select(F.col("index").cast("int").alias("index"), "term")
    return flat.join(vocab, "index").select("topic", "rank", "term", "weight")


def cluster_centers(spark, model) -> DataFrame:
    """``(cluster, size, pos, value)``: centres of a (bisecting) k-means fit
    with the training cluster sizes (k x d rows, model-sized)."""
    sizes = list(model.summary.clusterSizes) if model.hasSummary else [None] * len(model.clusterCenters())
    rows = [
        (i, int(sizes[i]) if sizes[i] is not None else None, j, float(v))
        for i, c in enumerate(model.clusterCenters())
        for j, v in enumerate(c)
    ]
    return spark.createDataFrame(rows, "cluster int, size bigint, pos int, value double")


def mixture_components(model: MK.GaussianMixtureModel) -> DataFrame:
    """``(component, weight, mean, cov)``: one row per Gaussian (weights sum to 1).
    The table has k rows (model-sized); components keep the model's order."""
    rows = model.gaussiansDF.collect()
    spark = model.gaussiansDF.sparkSession
    data = [(i, float(w), r["mean"], r["cov"]) for i, (w, r) in enumerate(zip(model.weights, rows))]
    return spark.createDataFrame(data, ["component", "weight", "mean", "cov"])
