"""The ridge solve against MLlib and against numpy."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.sql import functions as F

from starledger.operators.gram import moments
from starledger.plans.ridge import fit_ridge


def _table(spark, offset):
    """An offset, a constant column, one-hot slots, and sparse vectors among dense ones."""
    rnd = np.random.default_rng(7)
    rows = []
    for i in range(400):
        hot = i % 3
        x = [offset + rnd.normal(), 5.0, 100 * rnd.normal(), float(hot == 0), float(hot == 1), float(hot == 2)]
        y = 3 * (x[0] - offset) - 0.02 * x[2] + hot + rnd.normal() * 0.1
        rows.append((Vectors.dense(x) if i % 2 else Vectors.sparse(6, {k: v for k, v in enumerate(x) if v}), float(y)))
    return spark.createDataFrame(rows, ["features", "label"]).repartition(5)


@pytest.fixture(scope="module")
def table(spark):
    return _table(spark, 100.0)


@pytest.mark.parametrize("penalty", [0.1, 2.0])
def test_weights_are_those_of_mllib(table, penalty):
    own = fit_ridge(table, penalty)
    for kind in (LinearRegression(regParam=penalty), GeneralizedLinearRegression(family="gaussian", link="identity", regParam=penalty)):
        model = kind.fit(table)
        assert own.coefficients == pytest.approx(model.coefficients.toArray(), abs=1e-6)
        assert own.intercept == pytest.approx(model.intercept, rel=1e-6)
        gap = own.transform(table).withColumnRenamed("prediction", "own").join(model.transform(table), ["features", "label"])
        assert gap.agg(F.max(F.abs(F.col("own") - F.col("prediction")))).first()[0] < 1e-6


def test_without_a_penalty_dependent_columns_are_solved(table):
    own = fit_ridge(table, 0.0)
    rows = table.collect()
    x = np.array([r.features.toArray() for r in rows])
    y = np.array([r.label for r in rows])
    centred = x - x.mean(axis=0)
    want = centred @ np.linalg.lstsq(centred, y - y.mean(), rcond=1e-10)[0] + y.mean()
    assert x @ own.coefficients + own.intercept == pytest.approx(want, abs=1e-5)


def test_large_offsets_cost_no_digits(spark, table):
    """Unlike a Gram matrix that is not centred."""
    assert fit_ridge(_table(spark, 1e7)).coefficients == pytest.approx(fit_ridge(table).coefficients, abs=1e-6)


def test_flat_labels_and_single_rows(spark):
    flat = spark.createDataFrame([(Vectors.dense([float(i)]), 2.0) for i in range(4)], ["features", "label"])
    for df in (flat, flat.limit(1)):
        own = fit_ridge(df)
        assert own.coefficients.tolist() == [0.0] and own.intercept == 2.0
    with pytest.raises(ValueError, match="no rows"):
        fit_ridge(flat.limit(0))


def test_moments_of_many_columns(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(50, 300)) + 1e5
    df = spark.createDataFrame([(row.tolist(),) for row in x], "v array<double>").repartition(3)
    m = moments(df, "v")
    assert m.n == 50 and np.allclose(m.mean, x.mean(axis=0), rtol=1e-12)
    assert np.allclose(m.covariance, np.cov(x.T, bias=True), atol=1e-9)
