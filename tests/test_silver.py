from conftest import tuples

from starledger.plans import silver
from starledger.schemas import BRONZE_SCHEMA, ITEM_SCHEMA

BRONZE = [
    (1, 10, 4.0, 100, "x"),
    (1, 10, 4.0, 100, "x"),  # replay
    (1, 10, 5.0, 100, "x"),  # same key, another rating
    (1, 10, 2.0, 200, "x"),  # same pair, later
    (2, 99, 3.0, 100, "x"),  # unknown item
    (None, 10, 3.0, 100, "x"),
    (1, None, 3.0, 100, "x"),
    (1, 10, None, 300, "x"),
    (1, 10, float("nan"), 300, "x"),
    (1, 10, 3.0, None, None),
    (3, 11, 1.5, 100, None),
]
ITEMS = [
    (10, "Ten", "A|B"),
    (10, "Ten again", "A"),
    (11, "Eleven", ""),
    (12, None, "A"),
    (13, "Thirteen", None),
    (None, "None", "A"),
    (14, "Unrated", "C"),
]


def test_clean_ratings(spark):
    got = silver.clean_ratings(spark.createDataFrame(BRONZE, BRONZE_SCHEMA))
    assert tuples(got.select("user_id", "item_id", "rating", "ts")) == [
        (1, 10, 2.0, 200),
        (1, 10, 5.0, 100),
        (2, 99, 3.0, 100),
        (3, 11, 1.5, 100),
    ]


def test_clean_items(spark):
    got = silver.clean_items(spark.createDataFrame(ITEMS, ITEM_SCHEMA))
    assert sorted(map(tuple, got.collect())) == [
        (10, "Ten again", "A", ["A"]),
        (11, "Eleven", "", [""]),
        (14, "Unrated", "C", ["C"]),
    ]


def test_build_silver(spark):
    got = silver.build_silver(spark.createDataFrame(BRONZE, BRONZE_SCHEMA), spark.createDataFrame(ITEMS, ITEM_SCHEMA))
    assert got.columns == silver.ENRICHED_COLUMNS
    assert dict(got.dtypes)["rating_datetime"] == "timestamp"
    flat = got.select("user_id", "item_id", "title", "rating", got.rating_datetime.cast("string"))
    assert tuples(flat) == [
        (1, 10, "Ten again", 2.0, "1970-01-01 00:03:20"),
        (1, 10, "Ten again", 5.0, "1970-01-01 00:01:40"),
        (3, 11, "Eleven", 1.5, "1970-01-01 00:01:40"),
    ]


def test_silver_is_the_same_when_items_are_too_many_to_broadcast(spark):
    bronze, items = spark.createDataFrame(BRONZE, BRONZE_SCHEMA), spark.createDataFrame(ITEMS, ITEM_SCHEMA)
    large = silver.enrich(silver.clean_ratings(bronze), silver.clean_items(items), small=False)
    assert tuples(large) == tuples(silver.build_silver(bronze, items))


def test_items_of_silver(spark):
    built = silver.build_silver(spark.createDataFrame(BRONZE, BRONZE_SCHEMA), spark.createDataFrame(ITEMS, ITEM_SCHEMA))
    assert tuples(silver.items_of(built).select("item_id", "title")) == [(10, "Ten again"), (11, "Eleven")]
