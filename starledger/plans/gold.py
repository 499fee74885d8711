"""Ranked and summary tables.

Item-level tables are aggregated by item id before titles or tags are attached, so
the ratings are never joined, widened or exploded: what meets the item table is one
row per item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.operators.complete import complete_rows
from starledger.operators.dedupe import keep_greatest, keep_latest

MIN_RATINGS = 30


def item_totals(ratings: DataFrame) -> DataFrame:
    """Count and sum of ratings per item."""
    return ratings.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("rating_count"),
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rated"),
    )


def _mean(total: str, count: str, digits: int = 2):
    return F.round(F.try_divide(F.col(total), F.col(count)), digits)


def rank_items(totals: DataFrame, items: DataFrame) -> DataFrame:
    """Count, mean, title and tags of every rated item.

    Both sides are one row per item, so the join needs no hint and no salt.
    """
    titled = totals.join(items.select("item_id", "title", "tags"), "item_id")
    return titled.select(
        "item_id", "title", "tags", "rating_count", _mean("rating_sum", "rated").alias("avg_rating")
    )


def most_rated(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """The item ranking, most rated first."""
    return rank_items(item_totals(ratings), items).orderBy(F.desc("rating_count"), "item_id")


def with_enough_ratings(ranking: DataFrame, min_ratings: int = MIN_RATINGS) -> DataFrame:
    return ranking.filter(F.col("rating_count") >= F.lit(min_ratings))


def top_rated(ranking: DataFrame, min_ratings: int = MIN_RATINGS) -> DataFrame:
    """Items with enough ratings, best (rounded) mean first."""
    return with_enough_ratings(ranking, min_ratings).orderBy(
        F.desc("avg_rating"), F.desc("rating_count"), "item_id"
    )


def tag_totals(totals: DataFrame, items: DataFrame) -> DataFrame:
    """Rating count and mean per tag. Each rating counts once for every tag of its item."""
    tagged = totals.join(items.select("item_id", "tags_array"), "item_id").select(
        F.explode("tags_array").alias("tag"), "rating_count", "rating_sum", "rated"
    )
    summed = tagged.groupBy("tag").agg(
        F.sum("rating_count").alias("rating_count"),
        F.sum("rating_sum").alias("rating_sum"),
        F.sum("rated").alias("rated"),
    )
    return summed.select("tag", "rating_count", _mean("rating_sum", "rated").alias("avg_rating"))


def tag_stats(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Tag totals, best mean first."""
    return tag_totals(item_totals(ratings), items).orderBy(F.desc("avg_rating"), "tag")


def user_totals(ratings: DataFrame) -> DataFrame:
    """Rating count and mean per user."""
    return ratings.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("rating_count"), F.round(F.avg("rating"), 2).alias("avg_user_rating")
    )


def user_activity(ratings: DataFrame) -> DataFrame:
    """User totals, most active first."""
    return user_totals(ratings).orderBy(F.desc("rating_count"), "user_id")


def model_input(ratings: DataFrame, times_unique: bool = True) -> DataFrame:
    """(user, item, rating) without nulls, one row per pair: its latest rating.

    Cleaned ratings are unique on (user, item, time). Pass ``times_unique=False`` for
    any others; the highest rating then settles equal times.
    """
    pair = ["user_id", "item_id"]
    columns = complete_rows(ratings.select(*pair, "ts", "rating"), [*pair, "rating"])
    latest = keep_latest(columns, pair, "ts") if times_unique else keep_greatest(columns, pair, ["ts"])
    return latest.select(*pair, "rating")


def rating_distribution(ratings: DataFrame) -> DataFrame:
    """Rows per rating value."""
    return ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("count")).orderBy("rating")


def table_profile(df: DataFrame) -> DataFrame:
    """Row count and non-null count of every column, as (column, type, rows, present)."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n_{i}") for i, c in enumerate(df.columns)])
    lines = F.array(
        *[
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.col("rows"),
                F.col(f"n_{i}").alias("present"),
            )
            for i, field in enumerate(df.schema.fields)
        ]
    )
    return counts.select(F.inline(lines))


def headline_figures(pairs: DataFrame) -> DataFrame:
    """Total ratings, distinct items and users, and the mean rating, in one row.

    One scan: every row counts once for its item and once for its user, and both kinds of
    group are combined before a single shuffle. Null ids are not counted, their ratings are.
    """
    item, user = (pairs.schema[c].dataType for c in ("item_id", "user_id"))
    rating = pairs.schema["rating"].dataType
    by_item = F.struct(F.lit(True).alias("by_item"), "item_id", F.lit(None).cast(user).alias("user_id"), "rating")
    by_user = F.struct(F.lit(False).alias("by_item"), F.lit(None).cast(item).alias("item_id"), "user_id", F.lit(None).cast(rating).alias("rating"))
    groups = (
        pairs.select(F.inline(F.array(by_item, by_user)))
        .groupBy("by_item", "item_id", "user_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s"), F.count("rating").alias("r"))
    )
    return groups.agg(
        F.coalesce(F.sum(F.when(F.col("by_item"), F.col("n"))), F.lit(0)).alias("total_ratings"),
        F.count("item_id").alias("total_items"),
        F.count("user_id").alias("total_users"),
        F.round(F.try_divide(F.sum("s"), F.sum("r")), 2).alias("avg_rating"),
    )
