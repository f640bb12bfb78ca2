"""Feature engineering (inventory F1-F17, K3).

Thin wrappers over MLlib transformers with explicit output names, plus the
pieces MLlib leaves non-deterministic or unscalable: exact quantile splits
computed with distributed ranks, PCA with a fixed component sign, and a
flat ``(keys, pos, value)`` view of vector columns for checking.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import feature as MF
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.shaping import cached, exact_quantiles, label_frequency
from quarry.session import scratch_dir


def vector_entries(col: str) -> Column:
    """Non-zero entries of a vector column as ``array<struct<pos, value>>``,
    from the vector's own storage (sparse: indices and values; dense: values):
    the cost follows the stored entries, not the vector's size."""
    v = F.unwrap_udt(F.col(col))
    sparse = F.arrays_zip(v["indices"].alias("pos"), v["values"].alias("value"))
    dense = F.transform(v["values"], lambda x, i: F.struct(i.alias("pos"), x.alias("value")))
    entries = F.when(v["type"] == 0, sparse).otherwise(dense)
    return F.filter(entries, lambda e: e["value"] != 0)


def explode_vector(df: DataFrame, keys: Sequence[str], col: str, nonzero: bool = False) -> DataFrame:
    """``(keys..., pos, value)`` rows of a vector or array column.  With
    ``nonzero``, a vector's stored entries are read whatever its size."""
    if nonzero and _is_vector(df, col):
        return df.select(*keys, F.inline(vector_entries(col))).select(
            *keys, F.col("pos").cast("int").alias("pos"), "value"
        )
    arr = vector_to_array(F.col(col)) if _is_vector(df, col) else F.col(col).cast("array<double>")
    out = df.select(*keys, F.posexplode(arr).alias("pos", "value"))
    return out.where(F.col("value") != 0) if nonzero else out


def _is_vector(df: DataFrame, col: str) -> bool:
    return type(df.schema[col].dataType).__name__ == "VectorUDT"


def rformula(df: DataFrame, formula: str, features: str = "features", label: str = "label"):
    """Fit and apply an R formula; returns ``(model, transformed)``.  Strings
    are indexed by descending frequency (ties alphabetical); main-effect
    dummies drop the last level, interactions keep all levels."""
    model = MF.RFormula(formula=formula, featuresCol=features, labelCol=label).fit(df)
    return model, model.transform(df)


def sql_transform(df: DataFrame, statement: str) -> DataFrame:
    """SQL over ``__THIS__`` (the input DataFrame)."""
    return MF.SQLTransformer(statement=statement).transform(df)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", handle_invalid: str = "error") -> DataFrame:
    """Concatenate numeric / vector columns; nulls error, skip or keep (NaN).
    Array columns must be converted with ``array_to_vector`` first."""
    return MF.VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(df)


def bucketize(df: DataFrame, col: str, splits: Sequence[float], out: str, handle_invalid: str = "error") -> DataFrame:
    """Left-closed bins, the last closed on both sides; out-of-range values
    error, are skipped, or go to an extra bucket (``keep``)."""
    return MF.Bucketizer(splits=list(splits), inputCol=col, outputCol=out, handleInvalid=handle_invalid).transform(df)


def quantile_splits(df: DataFrame, col: str, n: int, relative_error: float | None = None) -> list[float]:
    """Bucket borders for ``n`` quantile buckets: quantiles at ``i/n``, outer
    borders replaced by -inf/+inf, duplicates merged.  ``relative_error=None``
    computes exact quantiles with distributed ranks (no driver-side sample);
    a number uses Spark's approximate summary with that error."""
    probs = [i / n for i in range(n + 1)]
    if relative_error is None:
        rows = exact_quantiles(df, col, probs).orderBy("p").collect()
        qs = [r["value"] for r in rows]
    else:
        qs = df.stat.approxQuantile(col, probs, relative_error)
    qs = [float(q) for q in qs]
    qs[0], qs[-1] = float("-inf"), float("inf")
    out: list[float] = []
    for q in qs:
        if not out or q != out[-1]:
            out.append(q)
    return out


def quantile_buckets(
    df: DataFrame, col: str, n: int, out: str, relative_error: float | None = None, handle_invalid: str = "error"
) -> DataFrame:
    """Quantile discretisation (``QuantileDiscretizer`` semantics)."""
    splits = quantile_splits(df, col, n, relative_error)
    return bucketize(df, col, splits, out, handle_invalid)


def standard_scale(df: DataFrame, col: str, out: str, with_mean: bool = False, with_std: bool = True) -> DataFrame:
    """Divide by the sample standard deviation (no centring by default); a
    zero-variance position maps to 0."""
    return MF.StandardScaler(inputCol=col, outputCol=out, withMean=with_mean, withStd=with_std).fit(df).transform(df)


def minmax_scale(df: DataFrame, col: str, out: str, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """Rescale each position to ``[lo, hi]``; a constant position maps to the midpoint."""
    return MF.MinMaxScaler(inputCol=col, outputCol=out, min=lo, max=hi).fit(df).transform(df)


def maxabs_scale(df: DataFrame, col: str, out: str) -> DataFrame:
    """Divide each position by its largest absolute value (no shift)."""
    return MF.MaxAbsScaler(inputCol=col, outputCol=out).fit(df).transform(df)


def elementwise_product(df: DataFrame, col: str, weights: Sequence[float], out: str) -> DataFrame:
    """Hadamard product with a constant vector."""
    return MF.ElementwiseProduct(scalingVec=Vectors.dense(list(weights)), inputCol=col, outputCol=out).transform(df)


def normalize(df: DataFrame, col: str, out: str, p: float = 2.0) -> DataFrame:
    """Scale each row to unit p-norm."""
    return MF.Normalizer(p=p, inputCol=col, outputCol=out).transform(df)


def index_strings(
    df: DataFrame, col: str, out: str, handle_invalid: str = "error", order: str = "frequencyDesc"
):
    """Most frequent value -> 0.0, ties by value as text; numbers are indexed
    as their text.  Returns ``(model, transformed)``; ``skip`` drops unseen
    values at transform time, ``keep`` maps them to an extra index."""
    model = MF.StringIndexer(inputCol=col, outputCol=out, handleInvalid=handle_invalid, stringOrderType=order).fit(df)
    return model, model.transform(df)


def label_dictionary(df: DataFrame, col: str) -> DataFrame:
    """``(value, count, index)`` of a column's texts, most frequent first, ties by text: the order of ``index_strings``,
    as a table of its own in place of a list of labels in the driver and every task.  Nulls have no index."""
    return label_frequency(df.where(F.col(col).isNotNull()), col)


def encode_strings(
    df: DataFrame, dictionary: DataFrame, col: str, out: str, handle_invalid: str = "error", hot_share: float = 0.001
) -> DataFrame:
    """``df`` with ``out``, the index of ``col`` in ``dictionary`` as a double.

    Values that hold more than ``hot_share`` of the dictionary's rows (at most ``1 / hot_share`` of them) are joined by
    broadcast, so no task gets a hot value's rows; all others by shuffle.  ``handle_invalid`` for nulls and values that
    the dictionary lacks: ``error`` raises when the rows are read, ``skip`` drops them, ``keep`` gives them the next
    free index."""
    if handle_invalid not in ("error", "skip", "keep"):
        raise ValueError(f"handle_invalid: {handle_invalid}")
    scratch_dir(df.sparkSession)
    dictionary = dictionary.select(F.col("value").alias("__value"), F.col("count"), F.col("index").cast("double").alias("__index")).checkpoint()
    size = dictionary.agg(F.sum("count").alias("rows"), F.count("*").alias("labels")).first()
    is_hot = F.col("count") > hot_share * (size["rows"] or 0)
    hot = dictionary.where(is_hot).select(F.col("__value").alias("__hot"), F.col("__index").alias("__hot_index"))
    rest = dictionary.where(~is_hot).select(F.concat(F.lit("v"), "__value").alias("__key"), "__index")
    rows = df.withColumn("__text", F.col(col).cast("string"))
    rows = rows.join(F.broadcast(hot), F.col("__text") == F.col("__hot"), "left")
    # rows of hot values and nulls need no second look: keys of their own keep them from meeting in one task
    needs = F.col("__hot").isNull() & F.col("__text").isNotNull()
    spread = F.concat(F.lit("h"), F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20)))
    rows = rows.withColumn("__key", F.when(needs, F.concat(F.lit("v"), "__text")).otherwise(spread))
    found = rows.join(rest, "__key", "left").withColumn(out, F.coalesce("__hot_index", "__index"))
    found = found.select(*df.columns, out)
    if handle_invalid == "skip":
        return found.where(F.col(out).isNotNull())
    if handle_invalid == "keep":
        return found.withColumn(out, F.coalesce(out, F.lit(float(size["labels"]))))
    message = F.concat(F.lit("no index for "), F.coalesce(F.col(col).cast("string"), F.lit("null")))
    return found.withColumn(out, F.when(F.col(out).isNull(), F.raise_error(message).cast("double")).otherwise(F.col(out)))


def unindex(df: DataFrame, col: str, out: str, labels: Sequence[str] | None = None) -> DataFrame:
    """Index -> text, from the column's ML metadata or explicit labels."""
    kw = {"labels": list(labels)} if labels is not None else {}
    return MF.IndexToString(inputCol=col, outputCol=out, **kw).transform(df)


def index_vector(df: DataFrame, col: str, out: str, max_categories: int = 20) -> DataFrame:
    """Positions with at most ``max_categories`` distinct values are re-coded
    to category indices (value order, 0.0 always index 0); others unchanged."""
    return MF.VectorIndexer(inputCol=col, outputCol=out, maxCategories=max_categories).fit(df).transform(df)


def one_hot(df: DataFrame, col: str, out: str, drop_last: bool = True) -> DataFrame:
    """Sparse one-hot vector of an index column; the last category is all-zero by default."""
    return MF.OneHotEncoder(inputCol=col, outputCol=out, dropLast=drop_last).fit(df).transform(df)


def fit_pca(df: DataFrame, col: str, k: int) -> MF.PCAModel:
    """Top-k principal components (MLlib builds the d x d covariance on the
    driver and states its own limit on d)."""
    return MF.PCA(k=k, inputCol=col, outputCol="__pca").fit(df)


@dataclass(frozen=True)
class WideComponents:
    """Components (``d x k``, sign-fixed, most variance first), their variances, the columns' means and the variance of
    all columns together."""

    loadings: np.ndarray
    variances: np.ndarray
    means: np.ndarray
    total_variance: float


def fit_pca_wide(df: DataFrame, col: str, k: int) -> WideComponents:
    """Top-k principal components by Spark's decomposition of the centred rows as a distributed matrix.

    From 100 columns on it multiplies the rows with a vector of the columns' width in every step, so neither the driver
    nor a task ever holds a ``d x d`` matrix (fewer columns, or k beyond half of them: a matrix of that size on the
    driver).  Centred rows are dense and kept (on disk where memory ends) while it runs.  Where the rows span
    fewer, the components beyond have a variance of zero but for rounding, or are left out; null vectors are left out; no or one row: ``ValueError``."""
    rows = df.where(F.col(col).isNotNull()).select((F.col(col) if _is_vector(df, col) else array_to_vector(F.col(col).cast("array<double>"))).alias("x"))
    n = rows.count()
    if n < 2:
        raise ValueError("components need two rows or more")
    scaler = MF.StandardScaler(withMean=True, withStd=False, inputCol="x", outputCol="c").fit(rows)
    centred = MLUtils.convertVectorColumnsFromML(scaler.transform(rows).select("c"), "c")
    with cached(centred) as held:
        svd = RowMatrix(held, n, len(scaler.mean)).computeSVD(k, computeU=False)
    s = np.array(svd.s.toArray())
    return WideComponents(_signed(svd.V.toArray()), s * s / (n - 1), scaler.mean.toArray(), float(np.square(scaler.std.toArray()).sum()))


def _signed(pc: np.ndarray) -> np.ndarray:
    """Components whose loading of largest magnitude is positive."""
    largest = pc[np.argmax(np.abs(pc), axis=0), np.arange(pc.shape[1])]
    return pc * np.where(largest < 0, -1.0, 1.0)


def pca_loadings(model: MF.PCAModel) -> np.ndarray:
    """``d x k`` loadings with a fixed sign: the largest-magnitude loading of
    every component is positive."""
    return _signed(model.pc.toArray())


def pca_project(df: DataFrame, col: str, model: MF.PCAModel | WideComponents, out: str) -> DataFrame:
    """Project (uncentred) rows on the sign-fixed components, as JVM expressions."""
    pc = model.loadings if isinstance(model, WideComponents) else pca_loadings(model)
    x = vector_to_array(F.col(col)) if _is_vector(df, col) else F.col(col).cast("array<double>")
    comps = []
    for j in range(pc.shape[1]):
        w = F.array(*[F.lit(float(v)) for v in pc[:, j]])
        comps.append(F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v))
    return df.withColumn(out, array_to_vector(F.array(*comps)))


def pca(df: DataFrame, col: str, k: int, out: str) -> DataFrame:
    """Fit PCA and project with sign-fixed components."""
    return pca_project(df, col, fit_pca(df, col, k), out)


def poly_expand(df: DataFrame, col: str, out: str, degree: int = 2) -> DataFrame:
    """All monomials up to ``degree`` (x1, x1^2, x2, x1x2, x2^2, ... for degree 2)."""
    return MF.PolynomialExpansion(degree=degree, inputCol=col, outputCol=out).transform(df)


def _label_counts(df: DataFrame, features: str, label: str) -> tuple[DataFrame, DataFrame, int]:
    """Stored entries ``(feature, value, label, n)``, rows per label ``(label, label_total)``, and the vector's width.
    Rows without label or vector are left out."""
    rows = df.where(F.col(label).isNotNull() & F.col(features).isNotNull()).select(F.col(label).cast("string").alias("label"), features)
    first = rows.select(F.size(vector_to_array(features)).alias("width") if _is_vector(df, features) else F.size(features).alias("width")).first()
    stored = explode_vector(rows, ["label"], features, nonzero=True)
    cells = stored.groupBy(F.col("pos").alias("feature"), "value", "label").agg(F.count(F.lit(1)).alias("n"))
    return cells, rows.groupBy("label").agg(F.count(F.lit(1)).alias("label_total")), first["width"] if first else 0


def contingency(df: DataFrame, features: str, label: str) -> DataFrame:
    """Counts ``(feature, value, label, n)`` of a feature vector's positions against the label, zeros too.  Only stored
    entries are exploded; the count of a zero is the label's rows less its stored ones."""
    cells, labels, width = _label_counts(df, features, label)
    grid = labels.withColumn("feature", F.explode(F.sequence(F.lit(0), F.lit(width - 1)))) if width else labels.withColumn("feature", F.lit(0))
    stored = cells.groupBy("feature", "label").agg(F.sum("n").alias("stored"))
    zeros = grid.join(stored, ["feature", "label"], "left").withColumn("n", F.col("label_total") - F.coalesce("stored", F.lit(0)))
    return cells.unionByName(zeros.where("n > 0").select("feature", F.lit(0.0).alias("value"), "label", "n"))


def _log_gamma(x: Column) -> Column:
    """ln gamma(x) for x > 0: Stirling's series at x + 8, less the factors between."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
    between = sum((F.log(x + i) for i in range(1, 8)), F.log(x))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - between


def chi2_tail(x: Column, dof: Column) -> Column:
    """P(chi-squared with ``dof`` degrees of freedom > x), as one expression: the regularised upper incomplete gamma
    function at (a, z) = (dof / 2, x / 2).  Below the mean one less the power series of the lower function; above it the
    upper sum, closed by the complementary error function for odd ``dof``.  Terms fall like exp(-n^2 / 2a), so some
    times sqrt(a) of them do."""
    a, z = dof.cast("double") / 2, x / 2
    head = F.exp(a * F.log(z) - z - _log_gamma(a + 1))
    most = (9 * F.sqrt(a) + 60).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total"))

    def summed(n: Column, ratio) -> Column:
        step = lambda s, i: F.struct((s["term"] * ratio(i)).alias("term"), (s["total"] + s["term"]).alias("total"))
        return F.aggregate(F.sequence(F.lit(1), n), start, step)["total"]

    lower = 1 - head * summed(most, lambda i: z / (a + i))
    whole = F.floor(a).cast("int")  # terms of the upper sum: a - 1, a - 2 ... down to 0 or a half
    upper = F.when(whole > 0, head * a / z * summed(F.least(whole, most), lambda i: (a - i) / z)).otherwise(0.0)
    fraction = F.aggregate(F.sequence(F.lit(200), F.lit(1)), F.lit(1.0), lambda v, n: 1 + n / (2 * z) / v)
    erfc = F.exp(-z) / (F.sqrt(z * math.pi) * fraction)
    upper = upper + F.when(dof % 2 == 1, erfc).otherwise(0.0)
    return F.when((dof <= 0) | (x <= 0), F.lit(1.0)).when(z < a + 1, F.greatest(lower, F.lit(0.0))).otherwise(upper)


def chi2_test(df: DataFrame, features: str, label: str) -> DataFrame:
    """Pearson's independence test per feature: ``featureIndex, pValue,
    degreesOfFreedom, statistic`` (one row per feature).

    The statistic is ``N * sum(n^2 / (row total * column total)) - N`` over the
    cells that occur (empty cells add nothing to that sum), so a label with as
    many values as customers only makes more rows.  Only stored entries are
    exploded and joined: with s stored rows of a label's c, its zero cell adds
    (c - s)^2 / c, which sums to N - 2 * stored + sum(s^2 / c) over the labels.
    A feature or label with one value has statistic 0 and p-value 1.  Rows
    without label or vector are left out."""
    cells, labels, width = _label_counts(df, features, label)
    total = labels.agg(F.sum("label_total").alias("n"), F.count("*").alias("labels")).first()
    size, n_labels = total["n"] or 0, total["labels"]
    n = F.col("n").cast("double")
    joined = cells.join(labels, "label")
    by_value = joined.groupBy("feature", "value").agg(
        F.sum("n").alias("row_total"), F.sum(n * n / F.col("label_total")).alias("squares"))
    by_label = joined.groupBy("feature", "label").agg(F.sum("n").alias("stored"), F.first("label_total").alias("label_total"))
    of_zero = by_label.groupBy("feature").agg(
        F.sum("stored").alias("stored"), F.sum(F.col("stored").cast("double") * F.col("stored") / F.col("label_total")).alias("zero_squares"))
    values = by_value.groupBy("feature").agg(F.sum(F.col("squares") / F.col("row_total")).alias("s"), F.count("*").alias("values"))
    every = df.sparkSession.range(width).select(F.col("id").cast("int").alias("feature"))
    stats = every.join(values, "feature", "left").join(of_zero, "feature", "left").na.fill(0)
    zeros = size - F.col("stored")
    zero_part = F.when(zeros > 0, (size - 2 * F.col("stored") + F.col("zero_squares")) / zeros).otherwise(0.0)
    dof = (F.col("values") + (zeros > 0).cast("long") - 1) * (n_labels - 1)
    statistic = F.when(dof > 0, F.greatest(size * (F.col("s") + zero_part) - size, F.lit(0.0))).otherwise(0.0)
    stats = stats.select(F.col("feature").alias("featureIndex"), statistic.alias("statistic"), dof.alias("degreesOfFreedom"))
    return stats.select(
        "featureIndex", chi2_tail(F.col("statistic"), F.col("degreesOfFreedom")).alias("pValue"),
        F.col("degreesOfFreedom").cast("int").alias("degreesOfFreedom"), "statistic")


def chi2_select(df: DataFrame, features: str, label: str, k: int, out: str) -> DataFrame:
    """Keep the ``k`` features most dependent on the label (least p-value,
    then greater statistic, then position), in their order."""
    best = chi2_test(df, features, label).orderBy("pValue", F.desc("statistic"), "featureIndex").limit(k)
    keep = sorted(r["featureIndex"] for r in best.collect())  # at most k rows
    return MF.VectorSlicer(inputCol=features, outputCol=out, indices=keep).transform(df)
