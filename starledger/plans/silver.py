"""Cleaning and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.functions.events import epoch_to_timestamp
from starledger.functions.tags import split_tags
from starledger.operators.complete import complete_rows
from starledger.operators.dedupe import keep_greatest
from starledger.operators.joins import fits_broadcast, lookup_join

RATING_COLUMNS = ["user_id", "item_id", "rating", "ts"]
ENRICHED_COLUMNS = ["user_id", "item_id", "title", "tags", "tags_array", "rating", "ts", "rating_datetime"]


def clean_ratings(bronze: DataFrame) -> DataFrame:
    """Complete ratings, one per (user, item, time); the highest rating wins a clash.

    The time text of bronze is left behind: it follows from ``ts``, and without it the
    de-duplication is a hash aggregate over numbers.
    """
    complete = complete_rows(bronze.select(*RATING_COLUMNS))
    return keep_greatest(complete, ["user_id", "item_id", "ts"])


def clean_items(items: DataFrame) -> DataFrame:
    """Complete items, one per id, with their tags as an array."""
    complete = complete_rows(items.select("item_id", "title", "tags"))
    return keep_greatest(complete, ["item_id"], ["title", "tags"]).withColumn("tags_array", split_tags(F.col("tags")))


def enrich(
    ratings: DataFrame, items: DataFrame, key_counts: DataFrame | None = None, small: bool | None = None
) -> DataFrame:
    """Cleaned ratings with their item's title and tags; unknown items drop out.

    ``key_counts`` and ``small`` are what ``lookup_join`` takes.
    """
    joined = lookup_join(ratings, items, "item_id", "inner", key_counts, small)
    return joined.withColumn("rating_datetime", epoch_to_timestamp(F.col("ts"))).select(*ENRICHED_COLUMNS)


def build_silver(bronze: DataFrame, items: DataFrame) -> DataFrame:
    """Bronze ratings and raw items to the enriched ratings table.

    The raw items are measured, which saves cleaning them twice. Should they be too
    many to broadcast, hot items are found in bronze, so nothing is cleaned twice then
    either: replays only make an item look hotter.
    """
    counts = complete_rows(bronze.select("item_id")).groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    small = fits_broadcast(items.select("item_id", "title", "tags", F.col("tags").alias("tags_array")))
    return enrich(clean_ratings(bronze), clean_items(items), counts, small)


def items_of(silver: DataFrame) -> DataFrame:
    """The item table contained in an enriched ratings table."""
    return keep_greatest(silver.select("item_id", "title", "tags"), ["item_id"], ["title", "tags"]).withColumn(
        "tags_array", split_tags(F.col("tags"))
    )
