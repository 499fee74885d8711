import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from starledger.operators.metrics import histogram, regression_metrics


def test_metrics_match_the_evaluator(spark):
    df = spark.range(500).select(
        (F.col("id") % 11).cast("double").alias("y"), (F.col("id") % 11 + F.sin("id")).alias("p")
    )
    got = regression_metrics(df, "y", "p").first()
    for name in ("rmse", "mae", "r2"):
        want = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(df)
        assert got[name] == pytest.approx(want, rel=1e-9)


def test_metrics_of_constant_labels_and_of_nothing(spark):
    one = regression_metrics(spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "y double, p double"), "y", "p").first()
    assert (one.rmse, one.mae, one.r2) == (1.0, 1.0, None)
    none = regression_metrics(spark.createDataFrame([], "y double, p double"), "y", "p").first()
    assert tuple(none) == (None, None, None)


def test_histogram_covers_every_row_once(spark):
    df = spark.range(1001).select((F.col("id") / 10).alias("x"))
    bins = histogram(df, "x").orderBy("bin").collect()
    assert [b.bin for b in bins] == list(range(1, 41))
    assert sum(b.n for b in bins) == 1001
    assert bins[0].bin_start == 0.0 and bins[-1].bin_end == 100.0
    assert bins[-1].n == bins[0].n + 1


def test_histogram_of_one_value_and_of_nothing(spark):
    same = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert [(b.bin, b.n) for b in histogram(same, "x").collect()] == [(1, 2)]
    assert histogram(same.limit(0), "x").collect() == []


def test_histogram_leaves_out_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    assert [(r.bin, r.n) for r in histogram(df, "x", 4).orderBy("bin").collect()] == [(1, 1), (4, 1)]
