"""Embedding whitening: principal components refined from single to double precision.

The covariance is summed by the tasks, each over its own distinct vectors, centred before
they are multiplied. Its eigenvectors come from a solver in single precision and are then
corrected by the iteration of Ogita and Aishima, which needs matrix products alone: with
R = I - X'X and S = X'AX the correction E of X' = X + XE is

    E[i, j] = (S[i, j] + l[j] R[i, j]) / (l[j] - l[i])    with  l[i] = S[i, i] / (1 - R[i, i])

where l[i] and l[j] are further apart than the present error, and R[i, j] / 2 elsewhere. The
products are in extended precision. Eigenvalues too close for that form clusters; each is
solved by itself in its own small space, shifted by its mean so that its differences keep
their digits, and the iteration goes on from there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.vectors import binary, matrix, measure, one_length, usable_rows, whole
from starledger.session import stage

COMPONENTS, SCALE = 4, 256
#: Corrections at most; each doubles the number of right digits.
STEPS = 12
#: Eigenvalues closer than this, as a share of the matrix, are always solved as a cluster: a
#: correction divides by their difference, which rounding in the products must not outweigh.
TWINS = 2.0**-34
#: Columns of the covariance in one row of a task's result.
STRIP = 128
#: An eigenvalue below this share of the trace, times the dimension, is taken for zero.
ZERO = 2.0**-48
_LONG = (1 << 63) - 1


def _clusters(values: np.ndarray, gap) -> list[np.ndarray]:
    """Groups of two or more indices whose values follow each other within ``gap``."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [group for group in np.split(order, cuts) if len(group) > 1]


def refined_eigenvectors(a: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix of doubles.

    Every vector's largest entry is positive. Vectors of equal eigenvalues are any
    orthonormal base of their space.
    """
    n = len(a)
    scale = float(np.abs(a).max()) or 1.0
    high = (a / scale).astype(np.longdouble)
    one = np.eye(n, dtype=np.longdouble)
    x = np.linalg.eigh((a / scale).astype(np.float32))[1].astype(np.longdouble)
    norm, before = np.linalg.norm(a / scale), np.inf
    for _ in range(steps):
        r = one - x.T @ x
        s = x.T @ high @ x
        r, s = (r + r.T) / 2, (s + s.T) / 2  # else rounding costs orthogonality
        values = np.diag(s) / (1 - np.diag(r))
        # What eigenvalues may still be off by; closer ones cannot be told apart yet.
        off = np.linalg.norm((s - np.diag(values)).astype(np.float64))
        gap = 2 * (off + norm * np.linalg.norm(r.astype(np.float64)))
        groups = _clusters(values, max(gap, TWINS * norm))
        own = np.arange(n)
        for group in groups:
            own[group] = group[0]
        apart = own[:, None] != own[None, :]
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, values[None, :] - values[:, None], 1), r / 2)
        x = x + x @ e
        if gap < 1e-4 * norm:
            for group in groups:
                x[:, group] = _solved_apart(high, x[:, group])
        moved = float(np.abs(e).max())
        if moved < 1e-17 or before < 1e-6 and moved > before / 4:  # what is left is rounding
            break
        before = moved
    x = x / np.sqrt((x * x).sum(axis=0))
    values = np.einsum("ij,ij->j", x, high @ x) * scale
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(n)] < 0, -1, 1)
    return values[order].astype(np.float64), x.astype(np.float64)


def _solved_apart(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A base of the space of ``x`` that diagonalises ``a`` within it."""
    for _ in range(2):  # orthonormal to extended precision
        for j in range(x.shape[1]):
            x[:, j] -= x[:, :j] @ (x[:, :j].T @ x[:, j])
            x[:, j] /= np.sqrt((x[:, j] ** 2).sum())
    ax = a @ x
    mean = np.einsum("ij,ij->", x, ax) / x.shape[1]
    inner = x.T @ (ax - mean * x)
    inner = (inner + inner.T) / 2
    size = np.abs(inner).max()
    if size == 0:
        return x
    turn = np.linalg.eigh((inner / size).astype(np.float64))[1].astype(np.longdouble)
    return x @ (turn + turn @ (np.eye(len(turn), dtype=np.longdouble) - turn.T @ turn) / 2)


def _whole_rows(rows: DataFrame, scale: int, kind: np.dtype) -> DataFrame:
    """(vec_id, x): whole vectors as bytes."""
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at, x in whole(batch.column("vector"), scale):
                ids = batch.column("vec_id").take(pa.array(at))
                yield pa.RecordBatch.from_arrays([ids, binary(x.astype(kind))], names=["vec_id", "x"])

    return rows.mapInArrow(run, f"vec_id {id_type}, x binary")


def _column_sums(fit: DataFrame, kind: np.dtype, dim: int) -> tuple[int, list[int]]:
    """(rows, exact sum of every dimension)."""

    def run(batches):
        n, sums = 0, [0] * dim
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("x"), kind)
                n += len(x)
                own = x.astype(np.int64).sum(axis=0).tolist() if kind.kind == "i" else [sum(map(int, c)) for c in x.T.tolist()]
                sums = [a + b for a, b in zip(sums, own)]
        yield pa.RecordBatch.from_pydict({"n": pa.array([n] * dim, pa.int64()), "place": pa.array(range(dim), pa.int32()), "total": pa.array(map(str, sums), pa.string())})

    each = fit.mapInArrow(run, "n bigint, place int, total string")
    # Whole numbers of at most 38 digits; one row per dimension.
    sums = each.groupBy("place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("s")).collect()
    return sums[0].n, [int(r.s) for r in sorted(sums, key=lambda r: r.place)]


def _covariance(fit: DataFrame, kind: np.dtype, mean: np.ndarray, n: int) -> np.ndarray:
    """Sums of products of centred vectors, divided by ``n``."""
    dim = len(mean)
    strips = [(i, i + STRIP) for i in range(0, dim, STRIP)]

    def run(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            for i in range(0, batch.num_rows, 8192):
                x = matrix(batch.column("x").slice(i, 8192), kind) - mean
                total += x.T @ x
        for strip, (i, j) in enumerate(strips):
            part = np.zeros((dim, STRIP))
            part[:, : min(j, dim) - i] = total[:, i:j]
            yield pa.RecordBatch.from_pydict({"place": pa.array(range(dim), pa.int32()), "strip": pa.array([strip] * dim, pa.int32()), "v": pa.array(list(part), pa.list_(pa.float64()))})

    used = min(STRIP, dim)
    each = fit.mapInArrow(run, "place int, strip int, v array<double>")
    summed = each.groupBy("place", "strip").agg(*[F.sum(F.col("v")[k]).alias(f"v{k}") for k in range(used)])
    v = np.zeros((dim, len(strips) * STRIP))
    for r in summed.collect():  # the matrix: dimension x dimension numbers
        v[r.place, r.strip * STRIP : r.strip * STRIP + used] = r[2:]
    v = v[:, :dim] / n
    return (v + v.T) / 2


def _identity_error(fit: DataFrame, project, m: int) -> float | None:
    """Largest absolute entry of the whitened covariance minus the identity."""
    names = [f"w{c}" for c in range(m)]

    def run(batches):
        for batch in batches:
            w = project(batch)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(w[:, c])) for c in range(m)], names=names)

    whitened = fit.mapInArrow(run, ", ".join(f"{c} double" for c in names))
    pairs = [(i, j) for i in range(m) for j in range(i, m)]
    got = whitened.agg(*[F.covar_pop(names[i], names[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(got, pairs))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum over dimensions of (n x - S)^2; None beyond 64 bits."""
    most = max(n * int(np.abs(x).max()) + max(map(abs, sums)), 1)
    if len(sums) * most**2 <= _LONG:
        return np.square(n * x.astype(np.int64) - np.array(sums, np.int64)).sum(axis=1).tolist()
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [d if d <= _LONG else None for d in exact]


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per row and component.

    A component c of a vector becomes floor(scale * c). The fit list is each distinct vector
    once: ``n`` of them, with sums S. ``deviation`` is the sum of (n x - S)^2, null beyond 64
    bits; ``whitened`` the centred vector's projection on the eigenvector, over the root of
    its eigenvalue; ``explained`` the eigenvalue's share of the trace; ``identity_error`` the
    largest absolute entry of the whitened covariance minus the identity, over all returned
    components of positive variance.

    Vectors that are null, have no component, or hold null or non-finite ones are dropped.
    Fewer dimensions than ``components`` give fewer rows. A component without variance, as
    when all vectors are equal, has a null ``whitened`` and explains 0; with none of positive
    variance ``identity_error`` is null. Repeated rows and null ids are returned like others.
    Vectors of several lengths are a ValueError. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = usable_rows(vectors, vec_id=vec_id, vector=vector)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    shape = measure(rows, scale)
    if not shape.rows:
        return spark.createDataFrame([], schema)
    if shape.bound > _LONG:
        raise ValueError("components are too large for 64 bits")
    dim, kind = one_length(shape), shape.kind
    numbers = stage(_whole_rows(rows, scale, kind), "whole-vectors")
    fit = stage(numbers.select("x").distinct(), "fit-list")
    n, sums = _column_sums(fit, kind, dim)
    mean = np.array([s / n for s in sums])
    covariance = _covariance(fit, kind, mean, n)
    values, axes = refined_eigenvectors(covariance)
    trace = float(np.trace(covariance))
    m = min(components, dim)
    positive = values[:m] > ZERO * dim * trace if trace > 0 else np.zeros(m, bool)
    live = int(positive.sum())  # eigenvalues fall, so these come first
    weights = axes[:, :live] / np.sqrt(values[:live])

    def project(batch: pa.RecordBatch) -> np.ndarray:
        return (matrix(batch.column("x"), kind) - mean) @ weights if batch.num_rows else np.empty((0, live))

    error = _identity_error(fit, project, live) if live else None
    explained = [float(v) / trace if p else 0.0 for v, p in zip(values[:m], positive)]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.num_rows
            w = project(batch)
            deviation = pa.array(_deviations(matrix(batch.column("x"), kind), n, sums), pa.int64())
            for c in range(m):
                whitened = pa.array(np.ascontiguousarray(w[:, c])) if c < live else pa.nulls(k, pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array([c + 1] * k, pa.int32()), pa.array([n] * k, pa.int64()), deviation, whitened, pa.array([explained[c]] * k), pa.array([error] * k, pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return numbers.mapInArrow(run, schema)
