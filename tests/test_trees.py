"""Rows routed through saved trees, and importances from their nodes, against MLlib."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from starledger.operators import joins
from starledger.plans import features, training, trees
from starledger.session import fresh_path, stage


@pytest.fixture(scope="module")
def table(spark):
    n = F.col("id")
    base = spark.range(1500).select(
        (n % 100).alias("user_id"), n.alias("item_id"), F.lit("t").alias("title"), F.lit("A").alias("tags"),
        F.concat(F.lit("tag"), (n % 5).cast("string")).alias("main_tag"),
        ((n % 7) * 0.5 + (n % 5) * (n % 3) - (n % 24) * 0.01).alias("rating"),
        F.lit(2020).alias("rating_year"), (n % 12 + 1).cast("int").alias("rating_month"),
        (n % 6 + 1).cast("int").alias("rating_dayofweek"), (n % 24).cast("int").alias("rating_hour"), F.lit(1).alias("tag_count"),
        (n % 3).alias("user_rating_count"), ((n % 5) * 0.1).alias("user_avg_rating"), F.lit(1).alias("item_rating_count"),
        ((n % 7) * 0.5).alias("item_avg_rating"),
    )
    return stage(features.encode_features(base)[1], "tree-features")


SMALL = {"Random Forest Regressor": {"numTrees": 6}, "GBT Regressor": {"maxIter": 5}}


@pytest.fixture(scope="module")
def saved(spark, table):
    train = training.labelled(table)[0]
    out = {}
    for name in training.TREE_MODELS:
        model = training.fit_regressor(train, name, SMALL.get(name))
        path = fresh_path(spark, "tree")
        training.save_model(model, path)
        out[name] = (model, path)
    return out


@pytest.mark.parametrize("name", training.TREE_MODELS)
@pytest.mark.parametrize("broadcast", [True, False])
def test_routed_predictions_and_importances(spark, table, saved, name, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(joins.fits_broadcast, "__defaults__", (0, 0))
    model, path = saved[name]
    test = training.labelled(table)[1]
    nodes = trees.node_table(spark, path)
    depth = training.depth_of(name) if broadcast else 3 if name == training.BOOSTED else training.depth_of(name)
    if not broadcast and name != training.SINGLE_TREE:
        test = test.limit(20)
        depth = training.depth_of(name)
    routed = trees.route(test.select("user_id", "item_id", "features", "label"), nodes, depth=depth)
    keys = ["user_id", "item_id"]
    found = trees.ensemble_predictions(routed, keys, averaged=training.trees_count_alike(name))
    both = model.transform(test).join(found, keys).collect()
    assert len(both) == test.count()
    assert all(r.prediction == pytest.approx(r.routed_prediction, abs=1e-9) for r in both)
    if broadcast:
        shares = {r.feature: r.importance for r in trees.node_importances(nodes, training.trees_count_alike(name)).collect()}
        theirs = model.featureImportances.toArray()
        assert [shares.get(i, 0.0) for i in range(len(theirs))] == pytest.approx(theirs, abs=1e-12)


def test_leaves_predict_the_mean_of_their_rows(spark, table, saved):
    train = training.labelled(table)[0]
    nodes = trees.node_table(spark, saved[training.SINGLE_TREE][1])
    leaves = trees.leaf_means(trees.route(train, nodes, depth=8)).collect()
    assert sum(r.rows for r in leaves) == train.count() and len(leaves) == nodes.filter("left IS NULL").count()
    assert all(r.mean == pytest.approx(r.prediction, abs=1e-9) for r in leaves)


def test_other_rows_do_not_meet_the_means(spark, table, saved):
    """The check can fail: labels that the tree was not grown from."""
    nodes = trees.node_table(spark, saved[training.SINGLE_TREE][1])
    rows = training.labelled(table)[0].withColumn("label", F.col("label") + F.col("item_id") % 2)
    assert any(abs(r.mean - r.prediction) > 0.1 for r in trees.leaf_means(trees.route(rows, nodes, depth=8)).collect())


def test_a_tree_without_splits(spark):
    rows = spark.createDataFrame([(i, Vectors.dense([1.0]), 3.0) for i in range(5)], ["k", "features", "label"])
    model = training.fit_regressor(rows, training.SINGLE_TREE)
    path = fresh_path(spark, "stump")
    training.save_model(model, path)
    nodes = trees.node_table(spark, path)
    assert [(r.k, r.prediction) for r in trees.route(rows, nodes, depth=2).orderBy("k").collect()] == [(i, 3.0) for i in range(5)]
    assert trees.node_importances(nodes, True).isEmpty()
    assert trees.route(rows.limit(0), nodes, depth=2).isEmpty()
