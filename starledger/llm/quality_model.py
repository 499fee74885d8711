"""Quality scores by regularised quadratic discriminant analysis of document statistics.

Statistics of each whole text are counted once and transformed; sums and products per
class, over all labelled training rows, are added up across tasks. Each class covariance
is shrunk towards the pooled one and towards its own scale. A score is the difference of
the classes' Mahalanobis log densities, from Cholesky factors made once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import held_out, map_slices, text_bytes
from starledger.llm.tokens import bound_batches
from starledger.session import stage

#: Shrinkage towards the pooled covariance, and of the result towards a multiple of the identity.
POOLED, SPHERE = 0.2, 0.05
#: Log-density differences are divided by this, as the statistics are not independent draws.
TEMPERATURE = 4.0

_BYTES = np.arange(256)
_CLASSES = {
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "lower": (_BYTES >= 97) & (_BYTES <= 122),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "wide": _BYTES >= 128,
    "space": np.isin(_BYTES, [9, 10, 11, 12, 13, 32]),
    "stop": np.isin(_BYTES, list(b".,;:?'\"-()")),
    "shout": np.isin(_BYTES, list(b"!")),
    "symbol": np.isin(_BYTES, list(b"#*$%&|<>@^~=+\\/_{}[]`")),
    "control": (_BYTES < 32) & ~np.isin(_BYTES, [9, 10, 11, 12, 13]),
}
_TABLE = np.array([v for v in _CLASSES.values()], np.float64).T
NAMES = [*_CLASSES, "bytes", "words", "word_length", "distinct_words", "commonest_word", "lines", "distinct_lines", "line_length"]


def statistics(text: bytes) -> list[float]:
    """Transformed statistics: logarithms of sizes, log-odds-like shares. Empty texts have the
    values of no characters at all."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n = max(len(text), 1)
    shares = (counts @ _TABLE) / n
    words = text.split()
    n_words = max(len(words), 1)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in text.split(b"\n") if x.strip()]
    n_lines = max(len(lines), 1)
    return [
        *np.log(shares + 0.002).tolist(),
        np.log1p(len(text)),
        np.log1p(len(words)),
        np.log1p(sum(map(len, words)) / n_words),
        np.log(len(seen) / n_words + 0.01),
        np.log(max(seen.values(), default=0) / n_words + 0.01),
        np.log1p(len(lines)),
        np.log(len(set(lines)) / n_lines + 0.01),
        np.log1p(len(text) / n_lines),
    ]


def with_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, x): the transformed statistics of each row."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [statistics(t) for t in text_bytes(batch.column("text"))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return map_slices(rows, run, f"doc_id {id_type}, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log terms of classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        logs = [
            off - 0.5 * (((x - mean) @ factor.T) ** 2).sum(axis=1)
            for mean, factor, off in zip(self.means, self.factors, self.offsets)
        ]
        return 1.0 / (1.0 + np.exp(np.clip((logs[0] - logs[1]) / TEMPERATURE, -500, 500)))


def class_counts(labels: DataFrame, label: str, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n0, n1): how often an id is labelled 0 and 1. Rows with a null id or label, or
    with another label, do not count."""
    counts = labels.groupBy(F.col(doc_id).alias("doc_id")).agg(
        F.count(F.when(F.col(label) == 0, 1)).alias("n0"), F.count(F.when(F.col(label) == 1, 1)).alias("n1")
    )
    return counts.filter("doc_id IS NOT NULL AND n0 + n1 > 0")


def fit(labelled: DataFrame, dim: int = len(NAMES)) -> Discriminant | None:
    """The discriminant of rows (x, n0, n1); None unless both classes occur.

    Tasks send one sum of products per class each; all that meets is (1 + dim + dim^2)
    numbers per class.
    """

    def sums(batches):
        total = np.zeros((2, 1 + dim + dim * dim))
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column("x").to_pylist())
                for c in (0, 1):
                    w = batch.column(f"n{c}").to_numpy(zero_copy_only=False).astype(float)
                    wx = x * w[:, None]
                    total[c] += np.concatenate(([w.sum()], wx.sum(axis=0), (wx.T @ x).ravel()))
        for c in (0, 1):
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * total.shape[1], pa.int32()), pa.array(np.arange(total.shape[1]), pa.int32()), pa.array(total[c])],
                names=["c", "i", "v"],
            )

    parts = labelled.select("x", "n0", "n1").mapInArrow(sums, "c int, i int, v double")
    total = np.zeros((2, 1 + dim + dim * dim))
    for r in parts.groupBy("c", "i").agg(F.sum("v").alias("v")).collect():
        total[r["c"], r["i"]] = r["v"]
    n = total[:, 0]
    if not n.all():
        return None
    means = total[:, 1 : dim + 1] / n[:, None]
    scatter = total[:, dim + 1 :].reshape(2, dim, dim) - n[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter.sum(axis=0) / n.sum() + 1e-6 * np.eye(dim)
    factors, offsets = [], []
    for c in (0, 1):
        cov = (1 - POOLED) * scatter[c] / n[c] + POOLED * pooled
        # Statistics differ in scale, so the sphere is one of standardised statistics.
        cov = (1 - SPHERE) * cov + SPHERE * np.diag(np.diag(pooled))
        chol = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(chol))
        offsets.append(np.log(n[c] / n.sum()) * TEMPERATURE - np.log(np.diag(chol)).sum())
    return Discriminant(means, np.array(factors), np.array(offsets))


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", at: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``.

    Labels are learnt only where ``held_out`` is false. Texts alone are scored; null and
    empty ones have the score of no characters. If the training labels lack a class the
    score is the share of the class they have (0.5 without labels). Repeated rows are
    scored alike, and learnt from once each. Labels of ids without a document do nothing.
    """
    rows = stage(with_statistics(docs, doc_id, text), "statistics")
    training = class_counts(labels, label).filter(~held_out(F.col("doc_id")))
    labelled = stage(rows.join(training, "doc_id"), "labelled")
    model = fit(labelled)
    if model is None:
        n = labelled.agg(F.sum("n1").alias("n1"), F.sum(F.col("n0") + F.col("n1")).alias("n")).first()
        scored = rows.select("doc_id", F.lit(n["n1"] / n["n"] if n["n"] else 0.5).alias("score"))
    else:
        id_type = rows.schema["doc_id"].dataType.simpleString()

        def run(batches):
            for batch in batches:
                score = model.score(np.array(batch.column("x").to_pylist())) if batch.num_rows else np.empty(0)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

        scored = rows.mapInArrow(run, f"doc_id {id_type}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= at, 1).otherwise(0).alias("predicted"))
