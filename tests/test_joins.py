import pytest
from conftest import plan_of, tuples
from pyspark.sql import functions as F

from starledger.operators.joins import fits_broadcast, hot_keys, lookup_join, salted_join


@pytest.fixture
def skewed(spark):
    """9,000 facts; a third have key 0, the others spread over 1..300; 7 is unknown."""
    facts = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 300 + 1).cast("long").alias("k"),
        F.col("id").alias("v"),
    )
    lookup = spark.range(400).filter("id <> 7").select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    return facts, lookup


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_gives_the_plain_join(skewed, how):
    facts, lookup = skewed
    counts = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = salted_join(facts, lookup, "k", how, counts)
    assert got.columns == ["k", "v", "w"]
    assert tuples(got) == tuples(facts.join(lookup, "k", how))


def test_hot_keys_are_bounded(skewed):
    facts, _ = skewed
    counts = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for parts in (2, 8, 64, 500):
        hot = hot_keys(counts, "k", parts).collect()
        assert len(hot) < parts
        assert sum(r._slices for r in hot) <= 2 * parts
        assert 0 in [r.k for r in hot] or parts < 3


def test_no_task_gets_a_hot_key_whole(spark, skewed):
    facts, lookup = skewed
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for key, value in zip(saved, ("-1", "false")):
            spark.conf.set(key, value)
        counts = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        joined = salted_join(facts, lookup, "k", "inner", counts, parts=32)
        held = joined.filter("k = 0").groupBy(F.spark_partition_id()).count()
        plain = facts.join(lookup, "k").filter("k = 0").groupBy(F.spark_partition_id()).count()
        assert plain.agg(F.max("count")).first()[0] == 3000
        assert held.agg(F.max("count")).first()[0] < 1500
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)


def test_even_keys_are_joined_plainly(spark):
    facts = spark.range(800).select((F.col("id") % 100).alias("k"), F.col("id").alias("v"))
    lookup = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    joined = salted_join(facts, lookup, "k", "inner", facts.groupBy("k").agg(F.count(F.lit(1)).alias("n")))
    assert "_slice" not in plan_of(joined)
    assert joined.count() == 800


def test_left_join_spreads_and_keeps_null_keys(spark):
    facts = spark.range(1000).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("v"))
    lookup = spark.createDataFrame([(1, 2)], "k long, w long")
    counts = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert salted_join(facts, lookup, "k", "left", counts).filter("w is null").count() == 1000


def test_size_check_measures_rows_and_bytes(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("s"), F.array(F.lit("ab")).alias("a"))
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=99)
    assert not fits_broadcast(df, max_bytes=100_000)
    assert fits_broadcast(df, max_bytes=120_000)
    assert fits_broadcast(df.limit(0))


def test_lookup_join_broadcasts_only_what_fits(skewed):
    facts, lookup = skewed
    assert "BroadcastHashJoin" in plan_of(lookup_join(facts, lookup, "k"))
    large = lookup_join(facts, lookup, "k", small=False)
    assert "_slice" in plan_of(large)
    assert tuples(large) == tuples(lookup_join(facts, lookup, "k"))
