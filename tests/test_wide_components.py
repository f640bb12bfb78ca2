"""Principal components by the distributed matrix, against numpy."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from quarry.operators import features as FE


@pytest.mark.parametrize("width, k", [(6, 2), (130, 4)])  # a small matrix on the driver; products with the rows
def test_components_match_numpy(spark, width, k):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, width)) * np.linspace(4, 0.2, width) + 7.0
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)] + [(300, None)], "i int, v array<double>")
    fit = FE.fit_pca_wide(df, "v", k)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert fit.variances == pytest.approx(values[::-1][:k], rel=1e-6)
    assert fit.total_variance == pytest.approx(values.sum()) and fit.means == pytest.approx(x.mean(axis=0))
    for j in range(k):
        assert abs(fit.loadings[:, j] @ vectors[:, -1 - j]) == pytest.approx(1.0, abs=1e-6)
        assert fit.loadings[np.argmax(np.abs(fit.loadings[:, j])), j] > 0
    out = FE.pca_project(df.where("v IS NOT NULL"), "v", fit, "t").select("i", vector_to_array("t").alias("t")).collect()
    got = np.array([r.t for r in sorted(out, key=lambda r: r.i)])
    assert got == pytest.approx(x @ fit.loadings, rel=1e-6)


def test_rows_that_span_less_and_too_few_rows(spark):
    df = spark.createDataFrame([([float(i), 2.0 * i, 5.0],) for i in range(20)], "v array<double>")
    fit = FE.fit_pca_wide(df, "v", 2)
    assert fit.variances[0] == pytest.approx(fit.total_variance)
    assert (fit.variances[1:] < 1e-9 * fit.total_variance).all()
    with pytest.raises(ValueError):
        FE.fit_pca_wide(df.limit(1), "v", 1)
