import pytest
from conftest import tuples
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from starledger.plans import features, silver


@pytest.fixture(scope="module")
def ratings(spark):
    # User 0 made a third of all ratings; some pairs are rated twice.
    rows = {}
    for n in range(1500):
        user = 0 if n % 3 == 0 else n % 50
        rows[(user, n % 37, 1_700_000_000 + (n * 7919) % 10_000_000)] = float(n % 10 + 1) / 2
    data = [(u, i, r, t) for (u, i, t), r in rows.items()]
    return spark.createDataFrame(data, "user_id long, item_id long, rating double, ts long")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(i, f"t{i}", "|".join(["A", "B", "C", "D"][i % 4 :])) for i in range(37)]
    return silver.clean_items(spark.createDataFrame(rows, "item_id long, title string, tags string"))


def _plain_features(ratings, items):
    """The same table by the plainest route: join first, de-duplicate last."""
    users = features.user_features(ratings)
    by_item = features.item_features(ratings)
    at = F.timestamp_seconds("ts")
    joined = (
        ratings.join(items, "item_id")
        .join(users, "user_id", "left")
        .join(by_item, "item_id", "left")
        .withColumn("main_tag", F.element_at("tags_array", 1))
        .withColumns(
            {
                "rating_year": F.year(at),
                "rating_month": F.month(at),
                "rating_dayofweek": F.dayofweek(at),
                "rating_hour": F.hour(at),
                "tag_count": F.size("tags_array"),
            }
        )
        .dropna()
    )
    best = joined.groupBy("user_id", "item_id").agg(F.max("ts").alias("ts"))
    return joined.join(best, ["user_id", "item_id", "ts"]).select(*features.BASE_COLUMNS)


def test_features_base(ratings, items):
    got = features.features_base(ratings, items)
    assert got.columns == features.BASE_COLUMNS
    assert tuples(got) == tuples(_plain_features(ratings, items))


def test_features_base_is_the_same_when_nothing_can_be_broadcast(spark, monkeypatch, ratings, items):
    want = tuples(features.features_base(ratings, items))
    monkeypatch.setattr(features, "fits_broadcast", lambda df: False)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert tuples(features.features_base(ratings, items)) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_statistics_from_other_ratings(ratings, items):
    past = ratings.filter("ts < 1705000000")
    got = features.features_base(ratings, items, stats_from=past)
    counts = {r.user_id: r["count"] for r in past.groupBy("user_id").count().collect()}
    assert all(r.user_rating_count == counts.get(r.user_id, 0) for r in got.collect())


def test_unknown_keys_keep_their_rows(ratings, items):
    past = ratings.filter("user_id <> 1 AND item_id <> 2")
    got = features.features_base(ratings, items, stats_from=past)
    assert got.count() == features.features_base(ratings, items).count()
    mean = past.agg(F.round(F.avg("rating"), 3)).first()[0]
    assert {(r.user_rating_count, r.user_avg_rating) for r in got.filter("user_id = 1").collect()} == {(0, mean)}
    assert {(r.item_rating_count, r.item_avg_rating) for r in got.filter("item_id = 2").collect()} == {(0, mean)}


def test_unknown_items_and_incomplete_rows_drop_out(spark, ratings, items):
    extra = spark.createDataFrame([(1, 999, 1.0, 5), (1, None, 1.0, 5), (1, 2, None, 5)], ratings.schema)
    got = features.features_base(ratings.union(extra), items)
    assert got.filter("item_id = 999 or item_id is null or rating is null").count() == 0
    assert got.count() == features.features_base(ratings, items).count()


def test_tag_occurrence_and_main_tag(spark):
    ratings = spark.createDataFrame([(1, 1, 1.0), (2, 1, 1.0), (1, 2, 1.0)], "user_id long, item_id long, rating double")
    items = silver.clean_items(
        spark.createDataFrame([(1, "x", "B|A|A"), (2, "y", "C|D"), (3, "z", "E")], "item_id long, title string, tags string")
    )
    occurrence = tuples(features.tag_occurrence(ratings, items))
    assert occurrence == [(1, "A", 4), (1, "B", 2), (2, "C", 1), (2, "D", 1)]
    assert tuples(features.main_tags(ratings, items)) == [(1, "A"), (2, "C")]


def test_encoding(spark, ratings, items, tmp_path):
    base = features.features_base(ratings, items)
    model, encoded = features.encode_features(base)
    by_count = [r.main_tag for r in base.groupBy("main_tag").count().orderBy(F.desc("count"), "main_tag").collect()]
    assert {r.main_tag: r.main_tag_index for r in encoded.collect()} == {t: float(n) for n, t in enumerate(by_count)}

    slots = features.slot_names(encoded)
    assert slots == [*features.NUMERIC_FEATURES, *[f"main_tag_vec_{t}" for t in by_count]]
    for row in encoded.select("*", vector_to_array("features").alias("v")).limit(50).collect():
        assert row.v[:9] == [float(row[c]) for c in features.NUMERIC_FEATURES]
        assert row.v[9:].index(1.0) == row.main_tag_index and sum(row.v[9:]) == 1.0

    encoded.write.parquet(str(tmp_path / "f"))
    assert features.slot_names(spark.read.parquet(str(tmp_path / "f"))) == slots
    unseen = model.transform(base.limit(1).withColumn("main_tag", F.lit("never seen")))
    assert sum(unseen.select(vector_to_array("main_tag_vec")).first()[0]) == 0.0
