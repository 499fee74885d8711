"""Boosted trees from binned rows, against MLlib's own."""

import os

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from starledger.plans import binned, boosting, training
from starledger.session import workspace


@pytest.fixture(scope="module")
def rows(spark):
    """Sparse and dense vectors: a measure with more values than bins, a small one, negative
    ones, seldom set slots, and a slot that never changes."""
    random = np.random.default_rng(5)
    data = []
    for i in range(3000):
        a, b, c, kind = random.integers(0, 200), random.integers(0, 7), random.integers(-3, 4), random.integers(0, 12)
        v = Vectors.sparse(18, [0, 1, 2, 3, 4 + int(kind)], [float(a), float(b), float(c), 1.0, 1.0])
        label = a * 0.013 + (b * 1.7 if kind < 5 else -b * 0.9) + c * c * 0.31 + kind * 0.23 + random.normal()
        data.append((i, v if i % 3 else Vectors.dense(v.toArray()), float(label)))
    return spark.createDataFrame(data, ["id", "features", "label"]).repartition(3)


def fitted(rows, **settings):
    estimator = GBTRegressor(featuresCol="features", labelCol="label", predictionCol="prediction", seed=42, **settings)
    return boosting.fit_boosted(rows, estimator), estimator.fit(rows)


def test_model_is_that_of_mllib(rows):
    own, theirs = fitted(rows, maxIter=12, maxDepth=4)
    both = own.transform(rows).select("id", F.col("prediction").alias("own")).join(theirs.transform(rows), "id")
    assert both.agg(F.max(F.abs(F.col("own") - F.col("prediction")))).first()[0] < 1e-6
    assert own.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-6)
    assert own.treeWeights == theirs.treeWeights
    assert own.getOrDefault("maxDepth") == 4 and type(own) is type(theirs)


def test_published_booster_keeps_few_bytes_a_row(spark, rows, monkeypatch):
    b = boosting.find_binning(rows, "features", 3000, 42)
    blocks = boosting.binned_blocks(rows, b, "features", "label")
    size = blocks.agg(F.sum(F.octet_length("residual") + F.octet_length("columns") + F.octet_length("loose"))).first()[0]
    assert size <= 3000 * (8 + 3 + 2)
    before = set(os.listdir(workspace(spark).removeprefix("file:"))), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr(training, "BINNED_ROWS", 2999)
    used = []
    monkeypatch.setattr(training, "fit_boosted", lambda *a: used.append(a) or boosting.fit_boosted(*a))
    model = training.fit_regressor(rows, training.BOOSTED, {"maxIter": 2, "maxDepth": 2})
    assert model.getNumTrees == 2 and len(used) == 1
    assert (set(os.listdir(workspace(spark).removeprefix("file:"))), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == before


def test_constant_label_and_no_rows(rows):
    flat = rows.withColumn("label", F.lit(2.5))
    assert {t.numNodes for t in fitted(flat, maxIter=2, maxDepth=3)[0].trees} == {1}
    with pytest.raises(ValueError):
        boosting.fit_boosted(rows.limit(0), GBTRegressor())


def test_no_pass_counts_more_than_half_of_the_rows(rows):
    """Beneath the root only the lesser of two children is added up; the other is what is left."""
    b = boosting.find_binning(rows, "features", 3000, 42)
    splitter, tree, blocks = binned.Splitter(b), binned.Tree(3), binned.staged_blocks(rows, b, "features", "label")
    for level in range(3):
        squares, counted = binned.level_histograms(blocks, b, {0: tree}, level)[0]
        assert counted[0, :, 0].sum() <= 3000 / (2 if level else 1)
        splitter.grow(tree, level, squares, counted)
        assert sum(v[0, 0] for v in tree.held.values()) == 3000
    assert len(tree.held) == 4
