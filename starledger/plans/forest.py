"""Random regression forests, grown from binned rows, as MLlib's own model."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame

from starledger.plans.binned import BATCH_BLOCKS, BINS, Splitter, Tree, arrow_batches, as_model, find_binning, leaf_sums, level_histograms, require, settle, staged_blocks
from starledger.session import temporary_tables


def fit_forest(train: DataFrame, estimator: RandomForestRegressor) -> RandomForestRegressionModel:
    """The model of MLlib's ``RandomForestRegressor``, all rows and all trees.

    As there, each tree draws every row by Poisson's law with the mean 1, and each node may be
    split by a third of the slots, drawn for it. Rows are binned once. A level of all trees is one
    pass that adds up histograms per node; they are summed by workers, and the driver gets one
    per tree and chooses the splits. Which rows a tree draws follows from the seed, the tree and
    the place of the row, so that every pass draws the same.
    """
    spark, value = train.sparkSession, estimator.getOrDefault
    require(estimator, {"subsamplingRate": 1.0, "bootstrap": True, "featureSubsetStrategy": "auto", "impurity": "variance", "maxBins": BINS, "minInstancesPerNode": 1, "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0})
    if value("numTrees") < 2:
        raise ValueError("a forest has two trees or more")
    features, label, depth, seed = value("featuresCol"), value("labelCol"), value("maxDepth"), value("seed")
    with temporary_tables(spark):
        rows = train.count()
        if not rows:
            raise ValueError("no rows to fit")
        b = find_binning(train, features, rows, seed)
        splitter, random = Splitter(b), np.random.default_rng(seed & (2**64 - 1))
        some = math.ceil(splitter.size / 3)
        blocks = staged_blocks(train, b, features, label)
        trees = {t: Tree(depth) for t in range(value("numTrees"))}
        with arrow_batches(spark, BATCH_BLOCKS):
            for level in range(depth):
                growing = {t: tree for t, tree in trees.items() if tree.counted(level)}
                if not growing:
                    break
                for t, (squares, counted) in sorted(level_histograms(blocks, b, growing, level, seed=seed).items()):
                    splitter.grow(trees[t], level, squares, counted, lambda: random.choice(splitter.size, some, replace=False))
            for t, sums in leaf_sums(blocks, b, trees, seed=seed).items():
                settle(trees[t], sums, whole=True)
        return as_model(spark, RandomForestRegressionModel, estimator, list(trees.values()), [1.0] * len(trees), b)
