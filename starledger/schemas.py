"""Column names and schemas shared by every layer.

Inside the package columns carry the plain names below. ``WIRE_NAMES`` maps them
to the names used on the wire and in published tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Field names of the JSON event, the item file and published tables.
WIRE_NAMES = {
    "user_id": "userId",
    "item_id": "movieId",
    "ts": "timestamp",
    "tags": "genres",
    "tags_array": "genres_array",
    "tag": "genre",
    "tag_count": "genre_count",
    "main_tag": "main_genre",
    "main_tag_index": "main_genre_index",
    "main_tag_vec": "main_genre_vec",
    "item_rating_count": "movie_rating_count",
    "item_avg_rating": "movie_avg_rating",
}

# ts is seconds since the epoch, held as a 64-bit number so that it outlives 2038.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("ts", T.LongType()),
    ]
)

ITEM_SCHEMA = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("tags", T.StringType()),
    ]
)

BRONZE_SCHEMA = T.StructType(
    [*EVENT_SCHEMA.fields, T.StructField("rating_datetime", T.StringType())]
)

ITEM_RANKING_SCHEMA = T.StructType(
    [
        *ITEM_SCHEMA.fields,
        T.StructField("rating_count", T.LongType()),
        T.StructField("avg_rating", T.DoubleType()),
    ]
)

COMPARISON_SCHEMA = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("r2", T.DoubleType()),
    ]
)

IMPORTANCE_SCHEMA = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("feature_name", T.StringType()),
        T.StructField("importance", T.DoubleType()),
    ]
)

PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("actual_rating", T.DoubleType()),
        T.StructField("predicted_rating", T.DoubleType()),
        T.StructField("residual", T.DoubleType()),
        T.StructField("model_name", T.StringType()),
    ]
)

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def wire_schema(schema: T.StructType) -> T.StructType:
    """The same schema under its wire names."""
    return T.StructType(
        [
            T.StructField(WIRE_NAMES.get(f.name, f.name), f.dataType, f.nullable, f.metadata)
            for f in schema.fields
        ]
    )


def wire_slot(slot: str) -> str:
    """The wire name of a slot of the feature vector."""
    vector = "main_tag_vec"
    if slot.startswith(f"{vector}_"):
        return WIRE_NAMES[vector] + slot.removeprefix(vector)
    return WIRE_NAMES.get(slot, slot)


def to_wire(df: DataFrame) -> DataFrame:
    """Rename plain columns to their wire names; other columns stay."""
    return df.withColumnsRenamed(WIRE_NAMES)


def from_wire(df: DataFrame) -> DataFrame:
    """Rename wire columns to their plain names; other columns stay."""
    return df.withColumnsRenamed({wire: plain for plain, wire in WIRE_NAMES.items()})
