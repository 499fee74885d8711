"""Toxicity scores by a counterfactually regularised linear classifier.

A document is the set of its words and of the beginnings of its words. From a bounded
sample of labelled training documents the features that tell the classes apart are chosen,
and a logistic model of them is fitted. Sentences that name a group of people are written
again with other groups' names; a change of the score between the two is penalised, so
that a mention of a group is no evidence by itself.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import held_out, map_slices
from starledger.llm.quality_model import class_counts
from starledger.llm.tokens import bound_batches
from starledger.session import stage

#: Documented bound: at most so many labelled training documents of each class are learnt from.
SAMPLE = 15_000
#: Features that the model may have, by strength of their association with the label.
FEATURES = 4096
#: A feature must occur in so many sampled documents.
LEAST_DOCS = 3
PREFIXES = (4, 5, 6)
RIDGE, COUNTERFACTUAL = 1e-3, 10.0
STEPS = 400

# Names of groups, by kind. Those of a kind may stand for each other; the last
# of each names no group.
IDENTITIES = (
    "women men girls boys mothers fathers people".split(),
    "woman man girl boy mother father person".split(),
    "muslims christians jews hindus buddhists atheists catholics people".split(),
    "muslim christian jewish hindu buddhist atheist catholic local".split(),
    "black white asian latino african european american arab local".split(),
    "gay lesbian straight bisexual transgender queer young".split(),
    "immigrants refugees foreigners natives disabled elderly people".split(),
    "frauen männer muslime christen juden schwarze weiße ausländer menschen".split(),
    "femmes hommes musulmans chrétiens juifs noirs blancs immigrés gens".split(),
    "mujeres hombres musulmanes cristianos judíos negros blancos inmigrantes personas".split(),
)
_PARTNERS = {w: [x for x in kind if x != w] for kind in IDENTITIES for w in kind[:-1]}
_WORDS = re.compile(r"\w+")
_ENDS = re.compile(r"[.!?\n]+")


def features(words: set[str]) -> set[str]:
    """Words, and beginnings of longer words marked with a star."""
    out = set(words)
    for n in PREFIXES:
        out.update([w[:n] + "*" for w in words if len(w) > n])
    return out


def words_in(text: str | None) -> set[str]:
    return set(_WORDS.findall(text.lower())) if text else set()


def sentences(text: str | None) -> list[set[str]]:
    """The words of each sentence that has any."""
    return [words for part in _ENDS.split(text or "") if (words := words_in(part))]


def changes(text: str | None) -> list[tuple[frozenset, frozenset]]:
    """What the document's features lose and gain when, in one sentence, one group's name
    becomes another's: for every sentence, name and partner, each different change once.

    The other sentences stay as they are, so what they have too is not lost.
    """
    parts = sentences(text)
    named = [part for part in parts if not part.isdisjoint(_PARTNERS)]
    if not named:
        return []
    held = Counter(f for part in parts for f in features(part))
    found = {}
    for part in named:
        words = Counter(f for word in part for f in features({word}))
        for name in sorted(part & _PARTNERS.keys()):
            own = {f for f in features({name}) if words[f] == 1 and held[f] == 1}
            for partner in _PARTNERS[name]:
                new = features({partner})
                found[frozenset(own - new), frozenset(new - held.keys())] = None
    return list(found)


def _sample(labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, y): up to ``bound`` training ids of each class, those with the least hashes. An
    id with labels of both classes counts for the more frequent, on a tie for none."""
    train = class_counts(labels, label).filter(~held_out(F.col("doc_id"))).filter("n0 <> n1")
    train = train.select("doc_id", (F.col("n1") > F.col("n0")).cast("int").alias("y"))
    order = F.md5(F.concat(F.lit("sample|"), F.col("doc_id").cast("string")))
    return train.filter("y = 0").orderBy(order).limit(bound).unionByName(train.filter("y = 1").orderBy(order).limit(bound))


def _feature_counts(sample: DataFrame) -> DataFrame:
    """(feature, y, n): sampled documents of each class that have a feature."""

    def run(batches):
        held: Counter = Counter()

        def out():
            keys = list(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([held[k] for k in keys], pa.int64())],
                names=["feature", "y", "n"],
            )
            held.clear()

        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                held.update([(f, y) for f in features(words_in(text))])
                if len(held) > 200_000:
                    yield from out()
        yield from out()

    return sample.mapInArrow(run, "feature string, y int, n bigint").groupBy("feature", "y").agg(F.sum("n").alias("n"))


def choose_features(sample: DataFrame, n: int = FEATURES) -> list[str]:
    """The features with the strongest association, names of groups always among them."""
    totals = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    all0, all1 = float(totals.get(0, 0)) + 1, float(totals.get(1, 0)) + 1
    by = _feature_counts(sample).groupBy("feature").agg(
        F.coalesce(F.sum(F.when(F.col("y") == 0, F.col("n"))), F.lit(0)).alias("n0"),
        F.coalesce(F.sum(F.when(F.col("y") == 1, F.col("n"))), F.lit(0)).alias("n1"),
    )
    odds = F.log((F.col("n1") + 0.5) / all1) - F.log((F.col("n0") + 0.5) / all0)
    strength = F.abs(odds) / F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    best = by.filter(F.col("n0") + F.col("n1") >= LEAST_DOCS).orderBy(strength.desc(), "feature").limit(n)
    chosen = [r["feature"] for r in best.select("feature").collect()]
    return list(dict.fromkeys([*features({w for kind in IDENTITIES for w in kind}), *chosen]))


def _examples(sample: DataFrame, index: dict[str, int]) -> DataFrame:
    """(y, x, lost, gained): indices of a document's features and of what each change of a
    name takes away and adds. Changes of no chosen feature are left out."""

    def numbered(names) -> list[int]:
        return sorted(index[f] for f in names if f in index)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, lost, gained = [], [], []
        for text in batch.column("text").to_pylist():
            x.append(numbered(features(words_in(text))))
            pairs = [(numbered(a), numbered(b)) for a, b in changes(text)]
            lost.append([a for a, b in pairs if a or b])
            gained.append([b for a, b in pairs if a or b])
        lists = pa.list_(pa.list_(pa.int32()))
        columns = [batch.column("y"), pa.array(x, pa.list_(pa.int32())), pa.array(lost, lists), pa.array(gained, lists)]
        return pa.RecordBatch.from_arrays(columns, names=["y", "x", "lost", "gained"])

    return map_slices(sample, run, "y int, x array<int>, lost array<array<int>>, gained array<array<int>>")


class _Rows:
    """Sparse 0/1 rows."""

    def __init__(self, rows: list[list[int]], width: int):
        self.columns = np.array([c for r in rows for c in r], np.int64)
        self.rows = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.shape = (len(rows), width)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, w[self.columns], minlength=self.shape[0])

    def back(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, v[self.rows], minlength=self.shape[1])


def fit(y: np.ndarray, x: list[list[int]], swaps: list[list[list[int]]], width: int, weight: float = COUNTERFACTUAL) -> np.ndarray:
    """``fit_changes`` of rewritten documents that are given whole, a list for each document."""
    pairs = [(set(own), set(new)) for own, news in zip(x, swaps) for new in news]
    return fit_changes(y, x, [sorted(a - b) for a, b in pairs], [sorted(b - a) for a, b in pairs], width, weight)


def fit_changes(
    y: np.ndarray, x: list[list[int]], lost: list[list[int]], gained: list[list[int]], width: int, weight: float = COUNTERFACTUAL
) -> np.ndarray:
    """Weights and, last, the intercept. The loss is the mean log loss with both classes of
    equal weight, a ridge, and ``weight`` times the mean squared change of the score over
    all rewritten documents. Adam, from zero."""
    rows = _Rows(x, width)
    ours, theirs = _Rows(lost, width), _Rows(gained, width)
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    w = np.zeros(width + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        p = 1.0 / (1.0 + np.exp(-np.clip(rows.dot(w[:-1]) + w[-1], -30, 30)))
        r = (p - y) * share
        grad = np.append(rows.back(r) + RIDGE * w[:-1], r.sum())
        if lost:
            change = ours.dot(w[:-1]) - theirs.dot(w[:-1])
            grad[:-1] += 2 * weight / len(lost) * (ours.back(change) - theirs.back(change))
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = SAMPLE, weight: float = COUNTERFACTUAL) -> dict[str, float] | None:
    """Feature weights, the intercept under the empty text; None unless both classes occur.

    docs (doc_id, text). The sample's ids are broadcast, at most 2 x ``bound`` of them; one
    task fits the model, on that bounded sample.
    """
    ids = stage(_sample(labels, label, bound), "sample-ids")
    sample = stage(docs.join(F.broadcast(ids), "doc_id").select("text", "y"), "sample")
    if sample.select("y").distinct().count() < 2:
        return None
    names = choose_features(sample)
    index = {f: i for i, f in enumerate(names)}

    def run(table: pa.Table) -> pa.Table:
        # Rows meet in any order; sums of the fit are the same to the last digit in one order.
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("y", "x", "lost", "gained"))))
        lost, gained = ([change for row in rows for change in row[i]] for i in (2, 3))
        w = fit_changes(np.array([r[0] for r in rows]), [r[1] for r in rows], lost, gained, len(names), weight)
        return pa.table({"weights": pa.array([w.tolist()], pa.list_(pa.float64()))})

    fitted = _examples(sample, index).withColumn("all", F.lit(0)).groupBy("all").applyInArrow(run, "weights array<double>")
    weights = fitted.first()["weights"]
    return {**{f: w for f, w in zip(names, weights) if w}, "": weights[-1]}


def toxicity_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", at: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``.

    Labels are learnt only where ``held_out`` is false, from a sample bounded by ``SAMPLE``
    documents of each class. Texts alone are scored, from first to last word; null and empty
    ones have the score of no feature. If the training labels lack a class every score is 0
    (1 if all are toxic). Repeated rows are scored alike, and learnt from once each.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    model = train(rows.filter("doc_id IS NOT NULL"), labels, label)
    if model is None:
        toxic = class_counts(labels, label).filter(~held_out(F.col("doc_id"))).filter("n1 > n0")
        scored = rows.select("doc_id", F.lit(0.0 if toxic.isEmpty() else 1.0).alias("score"))
    else:
        sent = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES numbers and the group names'
        id_type = rows.schema["doc_id"].dataType.simpleString()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            weights = sent.value
            keys = weights.keys()
            total = np.array([weights[""] + sum([weights[f] for f in features(words_in(t)) & keys]) for t in batch.column("text").to_pylist()])
            score = 1.0 / (1.0 + np.exp(-np.clip(total, -500, 500)))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "score"])

        scored = map_slices(rows, run, f"doc_id {id_type}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= at, 1).otherwise(0).alias("predicted"))
