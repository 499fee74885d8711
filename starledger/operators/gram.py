"""Means and covariances of all columns of a vector in one pass."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of the matrix in one row of a task's result.
STRIP = 128


@dataclass(frozen=True)
class Moments:
    """Rows, means and the covariance matrix (divisor: rows) of some columns."""

    n: int
    mean: np.ndarray
    covariance: np.ndarray


def moments(df: DataFrame, vector: str) -> Moments:
    """Moments of an array column whose values are all of one length, without nulls.

    Each task multiplies its own rows, less the first row of the table so that large offsets
    cost no digits, and returns one matrix; matrices are added by column strips. What reaches
    the driver is one matrix, whatever the number of rows.
    """
    first = df.select(vector).first()
    if first is None:
        return Moments(0, np.zeros(0), np.zeros((0, 0)))
    base = np.array(first[0], np.float64)
    size = len(base) + 1
    strips = range(0, size, STRIP)

    # Nested, so that workers need numpy and pyarrow but not this package.
    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros((size, len(strips) * STRIP))
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.column(0).slice(k, 4096)
                x = part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1) - base
                x = np.column_stack((np.ones(len(x)), x))
                total[:, :size] += x.T @ x
        for s in range(len(strips)):
            own = total[:, s * STRIP : (s + 1) * STRIP]
            yield pa.RecordBatch.from_pydict(
                {"place": pa.array(range(size), pa.int32()), "strip": pa.array([s] * size, pa.int32()), "v": pa.array(list(own), pa.list_(pa.float64()))}
            )

    used = min(STRIP, size)
    each = df.select(vector).mapInArrow(run, "place int, strip int, v array<double>")
    summed = each.groupBy("place", "strip").agg(*[F.sum(F.col("v")[k]).alias(f"v{k}") for k in range(used)])
    total = np.zeros((size, len(strips) * STRIP))
    for r in summed.collect():  # columns x columns numbers
        total[r.place, r.strip * STRIP : r.strip * STRIP + used] = r[2:]
    n = total[0, 0]
    shift = total[0, 1:size] / n
    covariance = total[1:size, 1:size] / n - np.outer(shift, shift)
    return Moments(int(n), base + shift, (covariance + covariance.T) / 2)
