"""Recommender over wide ids, and the proof of its fit."""

import numpy as np
import pytest
from conftest import tuples
from pyspark.sql import functions as F

from starledger.operators import joins
from starledger.operators.sampling import hash_split
from starledger.plans import training
from starledger.plans.recommender import Recommender, fit_recommender, fits_32_bits, optimality


@pytest.fixture(scope="module")
def pairs(spark):
    n = F.col("id")
    grid = spark.range(3000).select((n % 60).alias("user_id"), (n % 47).alias("item_id"))
    return grid.withColumn("rating", ((F.col("user_id") % 4) + 1) * ((F.col("item_id") % 3) + 1) / 3.0 + F.col("item_id") % 2)


def _wide(df):
    return df.withColumns({"user_id": F.col("user_id") * F.lit(1 << 33) - 9, "item_id": F.concat(F.lit("item "), F.col("item_id"))})


def test_which_ids_need_numbers(spark, pairs):
    assert fits_32_bits(pairs) and not fits_32_bits(_wide(pairs))
    assert not fits_32_bits(pairs.withColumn("item_id", F.col("item_id") - F.lit(1 << 31) - 1))
    assert fits_32_bits(pairs.limit(0))


def test_wide_ids_predict_what_plain_ones_do(spark, pairs, tmp_path):
    train, test = hash_split(pairs, ["user_id", "item_id"])
    plain = fit_recommender(train)
    assert plain.users is None and tuples(plain.transform(test)) == tuples(training.fit_als(train).transform(test))
    wide = fit_recommender(_wide(train))
    cold = spark.createDataFrame([(1, "item 1", 1.0), (-9, "no such item", 1.0)], _wide(test).schema)
    rows = _wide(test).unionByName(cold)
    got = wide.transform(rows)
    assert got.columns == [*rows.columns, "prediction"]
    assert tuples(got.drop("prediction")) == tuples(_wide(plain.transform(test).select(*test.columns)))
    wide.save(str(tmp_path / "als"))
    assert tuples(Recommender.load(spark, str(tmp_path / "als"), True).transform(rows)) == tuples(got)


def test_every_user_is_at_its_minimum(spark, pairs):
    model = fit_recommender(_wide(pairs))
    checked = optimality(model, _wide(pairs)).collect()
    assert len(checked) == 60 and all(r.optimal for r in checked)
    assert {r.ratings for r in checked} == {50}


def test_gradients_are_those_of_numpy(spark, pairs):
    """Another penalty moves the minimum: every gap is what numpy says, and none is small."""
    settings = {**training.ALS_SETTINGS, "regParam": 5.0}
    model = fit_recommender(pairs)
    x = {r.id: np.array(r.features, np.float64) for r in model.model.userFactors.collect()}
    y = {r.id: np.array(r.features, np.float64) for r in model.model.itemFactors.collect()}
    want = {}
    for user in x:
        own = [(y[r.item_id], np.float64(np.float32(r.rating))) for r in pairs.filter(F.col("user_id") == user).collect()] if user < 5 else []
        if own:
            weight = 5.0 * len(own)
            g = sum(v * (v @ x[user] - r) for v, r in own) + weight * x[user]
            size = sum(v * (r + v @ x[user]) for v, r in own) + weight * x[user]
            breach = np.where(x[user] > 0, np.abs(g), np.maximum(-g, 0))
            want[user] = max(b / s if s else 0.0 for b, s in zip(breach, size))
    got = {r.user_id: r for r in optimality(model, pairs, settings).collect()}
    assert all(got[u].gap == pytest.approx(v, rel=1e-9) and not got[u].optimal for u, v in want.items())


def test_hot_ids_are_sliced_when_tables_are_large(spark, pairs, monkeypatch):
    """Without broadcasts the numbers and the audit come out the same."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins.fits_broadcast, "__defaults__", (0, 0))
    hot = pairs.withColumn("user_id", F.when(F.col("user_id") < 40, 0).otherwise(F.col("user_id"))).dropDuplicates(["user_id", "item_id"])
    model = fit_recommender(_wide(hot))
    checked = optimality(model, _wide(hot)).collect()
    assert len(checked) == 21 and all(r.optimal for r in checked)


def test_audit_shuffles_ratings_twice_and_its_sums_not_at_all(spark, pairs, monkeypatch):
    """Large tables without hot ids: ratings and factors by item, then by user, and no more."""
    monkeypatch.setattr(joins.fits_broadcast, "__defaults__", (0, 0))
    model = fit_recommender(pairs)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        checked = optimality(model, pairs)
        plan = checked._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 4 and "array<double>" not in plan
        rows = checked.collect()
    finally:
        spark.conf.set(key, before)
    assert len(rows) == 60 and all(r.optimal for r in rows)


def test_fit_drops_the_messages_of_its_rounds(spark, pairs, monkeypatch):
    """The model still reads the messages since the last checkpoint, not those of ten rounds."""

    def shuffles():
        lineage = training.fit_als(pairs)._java_obj.userFactors().rdd().toDebugString()
        return lineage.count("ShuffledRDD")

    own = shuffles()
    monkeypatch.setattr(training, "ALS_CHECKPOINT", 10)
    assert own <= 8 and shuffles() >= 2 * own
