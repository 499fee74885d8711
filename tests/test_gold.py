import pytest
from conftest import plan_of, tuples
from pyspark.sql import functions as F

from starledger.plans import gold, silver, views


@pytest.fixture(scope="module")
def ratings(spark):
    rows = [(u, i, float((u * i) % 5 + 1) / 2, 1000 + u) for u in range(1, 41) for i in range(1, 8) if u % i == 0]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double, ts long")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(i, f"t{i}", "|".join("ABCDEFG"[: (i % 3) + 1])) for i in range(1, 8)]
    return silver.clean_items(spark.createDataFrame(rows, "item_id long, title string, tags string"))


def test_most_rated_is_a_plain_group_by(ratings, items):
    want = (
        ratings.join(items, "item_id")
        .groupBy("item_id", "title", "tags")
        .agg(F.count("*").alias("rating_count"), F.round(F.avg("rating"), 2).alias("avg_rating"))
    )
    got = gold.most_rated(ratings, items)
    assert tuples(got) == tuples(want)
    counts = [r.rating_count for r in got.collect()]
    assert counts == sorted(counts, reverse=True)


def test_top_rated_is_the_ranking_with_enough_ratings(ratings, items):
    ranking = gold.most_rated(ratings, items)
    got = gold.top_rated(ranking, 10).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in ranking.collect() if r.rating_count >= 10}
    assert got == sorted(got, key=lambda r: (-r.avg_rating, -r.rating_count, r.item_id))


def test_tag_stats_match_exploding_every_rating(ratings, items):
    want = (
        ratings.join(items, "item_id")
        .select(F.explode("tags_array").alias("tag"), "rating")
        .groupBy("tag")
        .agg(F.count("*").alias("rating_count"), F.round(F.avg("rating"), 2).alias("avg_rating"))
    )
    assert tuples(gold.tag_stats(ratings, items)) == tuples(want)
    total = ratings.join(items, "item_id").agg(F.sum(F.size("tags_array"))).first()[0]
    assert gold.tag_stats(ratings, items).agg(F.sum("rating_count")).first()[0] == total


def test_item_tables_join_after_the_aggregate(spark, tmp_path, ratings, items):
    """The join meets one row per item, never the ratings."""
    ratings.write.parquet(str(tmp_path / "r"))
    plan = gold.most_rated(spark.read.parquet(str(tmp_path / "r")), items)
    optimized = plan._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.index("Join Inner") < optimized.index("Aggregate [item_id")
    assert "ReadSchema: struct<item_id:bigint,rating:double>" in plan_of(plan)


def test_empty_tag_list_vanishes_and_empty_text_counts(spark):
    ratings = spark.createDataFrame([(1, 1, 2.0), (1, 2, 3.0)], "user_id long, item_id long, rating double")
    items = spark.createDataFrame([(1, []), (2, [""])], "item_id long, tags_array array<string>")
    assert tuples(gold.tag_stats(ratings, items)) == [("", 1, 3.0)]


def test_user_activity(ratings):
    got = gold.user_activity(ratings).collect()
    assert got == sorted(got, key=lambda r: (-r.rating_count, r.user_id))
    assert sum(r.rating_count for r in got) == ratings.count()


def test_model_input_keeps_the_latest(spark):
    rows = [(1, 1, 3.0, 10), (1, 1, 4.0, 20), (1, 1, 2.0, 15), (1, 2, 1.0, 5), (None, 1, 1.0, 1), (2, 2, None, 9)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double, ts long")
    assert tuples(gold.model_input(df)) == [(1, 1, 4.0), (1, 2, 1.0)]
    clash = df.union(spark.createDataFrame([(1, 1, 5.0, 20)], df.schema))
    assert tuples(gold.model_input(clash, times_unique=False)) == [(1, 1, 5.0), (1, 2, 1.0)]


def test_headline_figures_and_distribution(ratings):
    pairs = gold.model_input(ratings)
    row = gold.headline_figures(pairs).first()
    assert (row.total_ratings, row.total_items, row.total_users) == (pairs.count(), 7, 40)
    spread = gold.rating_distribution(pairs)
    assert spread.agg(F.sum("count")).first()[0] == pairs.count()


def test_table_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "a long, b string")
    assert [tuple(r) for r in gold.table_profile(df).collect()] == [("a", "bigint", 3, 3), ("b", "string", 3, 2)]


def test_views_break_ties_by_key(spark):
    rows = [(i, "t", "A", 10, 3.0) for i in range(20)]
    ranking = spark.createDataFrame(rows, "item_id long, title string, tags string, rating_count long, avg_rating double")
    for parts in (1, 5):
        shuffled = ranking.orderBy(F.desc("item_id")).repartition(parts)
        assert [r.item_id for r in views.most_rated_items(shuffled, 5).collect()] == [0, 1, 2, 3, 4]
        assert [r.item_id for r in views.best_rated_items(shuffled, 10, 3).collect()] == [0, 1, 2]
    assert views.best_rated_items(ranking, 11).collect() == []
    assert "TakeOrderedAndProject" in plan_of(views.most_rated_items(ranking, 5))


def test_model_views(spark):
    comparison = spark.createDataFrame(
        [("B", 0.5, 0.4, 0.3), ("A", 0.5, 0.6, 0.1), ("C", 0.9, 0.1, 0.2)], "model_name string, rmse double, mae double, r2 double"
    )
    assert views.best_model(comparison).first().model_name == "A"
    long = views.metrics_long(comparison)
    assert long.columns == ["model_name", "metric", "value"] and long.count() == 9
    assert tuples(views.model_names(long)) == [("A",), ("B",), ("C",)]
    importances = spark.createDataFrame(
        [("A", "x", 0.2), ("A", "y", 0.8), ("B", "x", 1.0)], "model_name string, feature_name string, importance double"
    )
    assert [r.feature_name for r in views.importance_for_model(importances, "A").collect()] == ["y", "x"]
