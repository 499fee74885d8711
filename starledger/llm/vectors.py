"""Vectors as whole numbers: what the exact vector operators share."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Shape:
    """Rows of a table of vectors, their least and greatest length, and the greatest
    absolute value of a component once scaled and floored."""

    rows: int
    least: int
    most: int
    bound: int

    @property
    def kind(self) -> np.dtype:
        """The narrowest type that holds every component exactly."""
        for kind in (np.int16, np.int32):
            if self.bound <= np.iinfo(kind).max:
                return np.dtype(kind)
        return np.dtype(np.float64)


def finite(vector: Column) -> Column:
    """Not null, not without components, and none of them null or not finite."""
    each = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(each & (F.size(vector) > 0), F.lit(False))


def usable_rows(vectors: DataFrame, **columns: str) -> DataFrame:
    """The named columns of rows with a finite vector; ``vector`` as doubles."""
    picked = vectors.select(*[F.col(c).alias(name) for name, c in columns.items()])
    return picked.withColumn("vector", F.col("vector").cast("array<double>")).filter(finite(F.col("vector")))


def measure(rows: DataFrame, scale: int) -> Shape:
    """One aggregate over ``vector``."""
    v = F.col("vector")
    top = F.greatest(F.abs(F.array_max(v)), F.abs(F.array_min(v)))
    n, least, most, top = rows.agg(F.count(F.lit(1)), F.min(F.size(v)), F.max(F.size(v)), F.max(top)).first()
    if not n:
        return Shape(0, 0, 0, 0)
    if not np.isfinite(scale * top):
        raise ValueError(f"a component of {top} cannot be multiplied by {scale}")
    return Shape(n, least, most, int(np.ceil(scale * top)) + 1)


def one_length(shape: Shape) -> int:
    """The common length of all vectors."""
    if shape.least != shape.most:
        raise ValueError(f"vectors of lengths {shape.least} to {shape.most}; one length is needed")
    return shape.most


def whole(column: pa.Array | pa.ChunkedArray, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors as floors of scale times the component), one length at a time."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False)) + 0.0
    starts = np.cumsum(lengths) - lengths
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        yield rows, flat[starts[rows][:, None] + np.arange(n)[None, :]]


def binary(x: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix."""
    x = np.ascontiguousarray(x)
    width = x.dtype.itemsize * x.shape[1]
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(x), [None, pa.py_buffer(x.tobytes())]).cast(pa.binary())


def matrix(column: pa.Array, kind: np.dtype) -> np.ndarray:
    """Back from ``binary``: all rows of one length."""
    data = column.cast(pa.large_binary())
    if not len(data):
        return np.empty((0, 0), kind)
    edges = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    return np.frombuffer(data.buffers()[2], kind, (edges[-1] - edges[0]) // kind.itemsize, edges[0]).reshape(len(data), -1)
