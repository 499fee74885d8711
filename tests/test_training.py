import pytest
from conftest import tuples
from pyspark.sql import functions as F

from starledger.catalog.inputs import Shared
from starledger.operators.metrics import regression_metrics
from starledger.operators.sampling import hash_split
from starledger.plans import features, training
from starledger.session import stage

SMALL = {
    "Random Forest Regressor": {"numTrees": 20, "maxDepth": 7},
    "GBT Regressor": {"maxIter": 4, "maxDepth": 3},
}


@pytest.fixture(scope="module")
def table(spark):
    """A rating that rises with the item's mean and falls with the hour."""
    n = F.col("id")
    base = spark.range(2000).select(
        (n % 100).alias("user_id"),
        n.alias("item_id"),
        F.concat(F.lit("t"), n.cast("string")).alias("title"),
        F.lit("A|B").alias("tags"),
        F.when(n % 3 == 0, "A").otherwise("B").alias("main_tag"),
        (1.0 + (n % 7) * 0.5 - (n % 24) * 0.01).alias("rating"),
        F.lit(2020).alias("rating_year"),
        (n % 12 + 1).cast("int").alias("rating_month"),
        (n % 6 + 1).cast("int").alias("rating_dayofweek"),
        (n % 24).cast("int").alias("rating_hour"),
        F.lit(2).alias("tag_count"),
        F.lit(20).cast("long").alias("user_rating_count"),
        ((n % 5) * 0.1).alias("user_avg_rating"),
        F.lit(1).cast("long").alias("item_rating_count"),
        (1.0 + (n % 7) * 0.5).alias("item_avg_rating"),
    )
    return stage(features.encode_features(base)[1], "test-features")


@pytest.fixture(scope="module")
def trained(table):
    train, test = training.labelled(table)
    return [training.train_regressor(train, test, name, SMALL.get(name)) for name in training.REGRESSORS]


def test_settings_are_the_published_ones():
    kinds = {name: dict(settings) for name, (_, settings) in training.REGRESSORS.items()}
    assert kinds == {
        "Linear Regression": {"maxIter": 50, "regParam": 0.1},
        "Decision Tree Regressor": {"maxDepth": 8, "seed": 42},
        "Random Forest Regressor": {"numTrees": 50, "maxDepth": 8, "seed": 42},
        "GBT Regressor": {"maxIter": 50, "maxDepth": 5, "seed": 42},
        "Generalized Linear Regression": {"family": "gaussian", "link": "identity", "maxIter": 50, "regParam": 0.1},
    }
    assert training.ALS_SETTINGS == {"rank": 10, "maxIter": 10, "regParam": 0.1}


def test_every_model_learns(table, trained):
    for result in trained:
        assert result.metrics["r2"] > 0.8, result


def test_training_rows_of_like_features_follow_each_other(table):
    train, _ = training.labelled(table)
    gathered = training.like_together(train.repartition(2, "title"))
    assert tuples(gathered) == tuples(train)
    means = [features.NUMERIC_FEATURES.index(f"{side}_avg_rating") for side in ("user", "item")]
    for part in gathered.rdd.glom().collect():
        pairs = [tuple(round(float(r.features[i]) * 4) for i in means) for r in part]
        assert pairs and pairs == sorted(pairs)


def test_shared_training_rows_are_stored_that_way(spark, table, tmp_path):
    shared = Shared(spark, str(tmp_path))
    shared._once("features", lambda: table)
    rows = shared.split()[0]
    i = features.NUMERIC_FEATURES.index("user_avg_rating")
    for part in rows.rdd.glom().collect():
        users = [round(float(r.features[i]) * 4) for r in part]
        assert users == sorted(users)
    assert tuples(rows) == tuples(training.labelled(table)[0])


def test_unpenalised_linear_model_finds_the_rule(table):
    train, test = training.labelled(table)
    result = training.train_regressor(train, test, "Linear Regression", {"regParam": 0.0})
    slots = dict(zip(features.slot_names(table), result.model.coefficients))
    assert result.metrics["rmse"] < 1e-6
    assert slots["item_avg_rating"] == pytest.approx(1.0, abs=1e-4)
    assert slots["rating_hour"] == pytest.approx(-0.01, abs=1e-4)


def test_comparison_is_sorted_and_best_is_first(spark, trained):
    rows = training.comparison_table(spark, trained).collect()
    assert len(rows) == 5 and [r.rmse for r in rows] == sorted(r.rmse for r in rows)
    assert rows[0].model_name == training.best_of(trained).name


def test_first_model_wins_a_tie():
    tie = [training.Trained(n, None, {"rmse": 1.0}) for n in ("B", "A")]
    assert training.best_of(tie).name == "B"


def test_importances(spark, table, trained):
    slots = features.slot_names(table)
    rows = training.importance_table(spark, trained, slots)
    assert rows.count() == 3 * len(slots)
    assert {r.feature_name for r in rows.collect()} == set(slots)
    for total in rows.groupBy("model_name").agg(F.sum("importance").alias("s")).collect():
        assert total.s == pytest.approx(1.0)


def test_published_predictions(table, trained):
    _, test = training.labelled(table)
    every = training.published_predictions(trained, test)
    assert every.count() == test.count()
    assert all(r.residual == r.actual_rating - r.predicted_rating for r in every.collect())
    assert {r.model_name for r in every.collect()} == {training.best_of(trained).name}
    assert training.published_predictions(trained, test, 7).count() == 7


def test_saved_model_predicts_the_same(spark, table, trained, tmp_path):
    _, test = training.labelled(table)
    for result in trained:
        training.save_model(result.model, str(tmp_path / "m"))
        loaded = type(result.model).load(str(tmp_path / "m"))
        again = regression_metrics(training.predictions_of(loaded, test, "m"), "actual_rating", "predicted_rating")
        assert again.first().rmse == pytest.approx(result.metrics["rmse"])


def test_run_record(spark):
    rows = training.run_record(spark, "m", {"depth": 3}, {"rmse": 0.5}, "/models/m").collect()
    assert {(r.run_name, r.kind, r.key, r.value) for r in rows} == {
        ("m", "param", "depth", "3"),
        ("m", "metric", "rmse", "0.5"),
        ("m", "artifact", "model", "/models/m"),
    }
    assert len({r.run_id for r in rows}) == 1


def test_als(spark):
    pairs = spark.range(3000).select(
        (F.col("id") % 60).alias("user_id"), (F.col("id") % 47).alias("item_id")
    ).withColumn("rating", ((F.col("user_id") % 4) + 1) * ((F.col("item_id") % 3) + 1) / 3.0)
    train, test = hash_split(pairs, ["user_id", "item_id"])
    model = training.fit_als(train)
    assert model.rank == 10
    scored = model.transform(test)
    assert regression_metrics(scored, "rating", "prediction").first().rmse < 0.5
    cold = spark.createDataFrame([(10_000, 1, 1.0)], "user_id long, item_id long, rating double")
    assert model.transform(cold).count() == 0
    for factors in (model.userFactors, model.itemFactors):
        assert factors.select(F.array_min("features").alias("least")).filter("least < 0").count() == 0
    again = training.fit_als(train).transform(test)
    assert tuples(again) == tuples(scored)
