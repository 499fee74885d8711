"""The feature table: statistics per user and item, date parts, encoded main tag."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.functions.events import epoch_to_timestamp, time_parts
from starledger.functions.tags import main_tag, tag_count
from starledger.operators.complete import complete_rows
from starledger.operators.dedupe import keep_latest
from starledger.operators.joins import fits_broadcast, lookup_join
from starledger.plans.gold import item_totals
from starledger.session import stage

# The columns of the feature table and the order of the vector's slots.
NUMERIC_FEATURES = [
    "rating_year",
    "rating_month",
    "rating_dayofweek",
    "rating_hour",
    "tag_count",
    "user_rating_count",
    "user_avg_rating",
    "item_rating_count",
    "item_avg_rating",
]
BASE_COLUMNS = ["user_id", "item_id", "title", "tags", "main_tag", "rating", *NUMERIC_FEATURES]


def user_features(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("user_rating_count"), F.round(F.avg("rating"), 3).alias("user_avg_rating")
    )


def item_features(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("item_rating_count"), F.round(F.avg("rating"), 3).alias("item_avg_rating")
    )


def tag_occurrence(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Ratings per (item, tag), counted per item first and exploded afterwards."""
    tagged = item_totals(ratings).join(items.select("item_id", "tags_array"), "item_id")
    return (
        tagged.select("item_id", F.explode("tags_array").alias("tag"), "rating_count")
        .groupBy("item_id", "tag")
        .agg(F.sum("rating_count").alias("tag_occurrence"))
    )


def main_tags(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """The main tag of every rated item: most occurrences, earliest in the list on ties.

    All ratings of an item share its tag list, so the list alone decides.
    """
    rated = ratings.select("item_id").distinct()
    tagged = rated.join(items.select("item_id", main_tag(F.col("tags_array")).alias("main_tag")), "item_id")
    return tagged.filter(F.col("main_tag").isNotNull())


def features_base(ratings: DataFrame, items: DataFrame, stats_from: DataFrame | None = None) -> DataFrame:
    """Feature rows, one per (user, item): its latest rating with all features.

    ``ratings`` are cleaned ratings of known items, such as the enriched table.
    ``stats_from`` takes the user and item statistics from other ratings, such as a
    training split; by default they come from ``ratings`` themselves. A user or item that
    has none there gets the count 0 and the mean of all of them; no rating is lost.

    Ratings are thinned to one per pair before the joins, on four narrow columns. The
    joins repeat no row and depend on the pair alone, so the result is the same. All
    item columns arrive in a single join, the last, so no shuffle carries titles. The two statistics tables are written once:
    their sizes decide how to join, and their counts say which keys are hot.
    """
    rated = complete_rows(ratings.select("user_id", "item_id", "rating", "ts"))
    base = rated if stats_from is None else complete_rows(stats_from.select(*rated.columns))
    users = stage(user_features(base), "user-features")
    item_columns = items.select(
        "item_id",
        "title",
        "tags",
        main_tag(F.col("tags_array")).alias("main_tag"),
        tag_count(F.col("tags_array")).alias("tag_count"),
    )
    if stats_from is None:
        described = item_features(base).join(item_columns, "item_id", "left")
    else:
        described = item_columns.join(item_features(base), "item_id", "left")
    described = stage(described, "item-features")

    latest = keep_latest(rated, ["user_id", "item_id"], "ts")
    with_users = lookup_join(
        latest,
        users,
        "user_id",
        "left",
        key_counts=users.select("user_id", F.col("user_rating_count").alias("n")),
        small=fits_broadcast(users),
    )
    joined = lookup_join(
        with_users,
        described,
        "item_id",
        "left",
        key_counts=described.select("item_id", F.coalesce("item_rating_count", F.lit(0)).alias("n")),
        small=fits_broadcast(described),
    )
    if stats_from is not None:
        mean = F.coalesce(base.agg(F.round(F.avg("rating"), 3)).scalar(), F.lit(0.0))
        for side in ("user", "item"):
            joined = joined.withColumn(f"{side}_rating_count", F.coalesce(f"{side}_rating_count", F.lit(0)))
            joined = joined.withColumn(f"{side}_avg_rating", F.coalesce(f"{side}_avg_rating", mean))
    dated = joined.withColumns(time_parts(epoch_to_timestamp(F.col("ts"))))
    return complete_rows(dated.select(*BASE_COLUMNS))


def encoder() -> Pipeline:
    """Main tag to index and one-hot slots, then everything into one vector."""
    return Pipeline(
        stages=[
            StringIndexer(inputCol="main_tag", outputCol="main_tag_index", handleInvalid="keep"),
            OneHotEncoder(inputCols=["main_tag_index"], outputCols=["main_tag_vec"]),
            VectorAssembler(
                inputCols=[*NUMERIC_FEATURES, "main_tag_vec"], outputCol="features", handleInvalid="keep"
            ),
        ]
    )


def encode_features(base: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """Fit the encoder and add ``main_tag_index``, ``main_tag_vec`` and ``features``."""
    model = encoder().fit(base)
    return model, model.transform(base)


def slot_names(features: DataFrame, column: str = "features") -> list[str]:
    """The name of every slot of the vector, from the column's metadata."""
    groups = features.schema[column].metadata["ml_attr"]["attrs"]
    slots = {slot["idx"]: slot["name"] for group in groups.values() for slot in group}
    return [slots[i] for i in sorted(slots)]
