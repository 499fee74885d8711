"""Linear regression with a ridge penalty, from one pass over the rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.operators.gram import Moments, moments


@dataclass(frozen=True)
class Ridge:
    coefficients: np.ndarray
    intercept: float

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """``df`` with ``prediction``."""
        weights = F.array(*[F.lit(float(c)) for c in self.coefficients])
        product = F.zip_with(vector_to_array(features), weights, lambda x, w: x * w)
        return df.withColumn("prediction", F.aggregate(product, F.lit(self.intercept), lambda t, v: t + v))


def solve(m: Moments, penalty: float) -> Ridge:
    """Least squares on standardised columns, the last of which is the label.

    Minimises half the mean squared error plus penalty / 2 times the squared coefficients,
    features and label both in units of their standard deviations, the penalty divided by
    that of the label: what MLlib's linear models minimise. Columns without variance get no
    weight. By Cholesky factors; without a penalty columns may depend on each other, and then
    the shortest solution is taken.
    """
    size = len(m.mean) - 1
    spread = np.sqrt(np.maximum(np.diag(m.covariance), 0))
    # A column that is constant up to rounding.
    spread[spread <= 1e-12 * np.maximum(np.abs(m.mean), 1e-300)] = 0
    live = np.flatnonzero(spread[:size])
    coefficients = np.zeros(size)
    y = spread[size]
    if y and len(live):
        a = m.covariance[np.ix_(live, live)] / np.outer(spread[live], spread[live])
        b = m.covariance[live, size] / (spread[live] * y)
        a = a + np.eye(len(live)) * (penalty / y)
        try:
            low = np.linalg.cholesky(a)
            if np.diag(low).min() < 1e-7:
                raise np.linalg.LinAlgError
            own = np.linalg.solve(low.T, np.linalg.solve(low, b))
        except np.linalg.LinAlgError:
            own = np.linalg.lstsq(a, b, rcond=1e-12)[0]
        coefficients[live] = own * y / spread[live]
    return Ridge(coefficients, float(m.mean[size] - coefficients @ m.mean[:size]))


def fit_ridge(train: DataFrame, penalty: float = 0.1, features: str = "features", label: str = "label") -> Ridge:
    """Fit ``label`` by ``features``, a vector column."""
    columns = F.array_append(vector_to_array(features), F.col(label).cast("double")).alias("_row")
    m = moments(train.select(columns), "_row")
    if not m.n:
        raise ValueError("no rows to fit")
    return solve(m, penalty)
