"""Joins of a large fact table with a lookup table that is unique on its key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starledger.session import stage

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def _row_bytes(df: DataFrame) -> Column:
    """A rough width of each row: text by its length, anything else by a flat figure."""
    widths = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            widths.append(F.coalesce(F.octet_length(column), F.lit(0)) + 8)
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
            text = F.coalesce(F.octet_length(F.array_join(column, "")), F.lit(0))
            widths.append(text + 16 * F.coalesce(F.array_size(column), F.lit(0)))
        else:
            widths.append(F.lit(8))
    return sum(widths, F.lit(16)).cast("bigint")


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` with one aggregate: is it small enough to send to every executor?"""
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    key_counts: DataFrame | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Join facts to a lookup: by broadcast when its measured size allows, else salted.

    ``key_counts`` (key, n) estimates how many facts each key has; without it the
    facts are counted. ``small`` passes on a size check the caller has already made.
    """
    if fits_broadcast(lookup) if small is None else small:
        return facts.join(F.broadcast(lookup), key, how)
    if key_counts is None:
        key_counts = facts.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return salted_join(facts, lookup, key, how, key_counts)


def hot_keys(key_counts: DataFrame, key: str, parts: int) -> DataFrame:
    """Keys with more than an even share of the rows, and the slices each needs.

    Fewer than ``parts`` keys can exceed a 1/parts share and their slices sum to less
    than 2 x parts, so the result is bounded whatever the size of the data.
    """
    share = key_counts.agg(F.sum("n") / F.lit(parts)).scalar()
    return key_counts.filter(F.col("n") > share).select(key, F.ceil(F.col("n") / share).cast("int").alias("_slices"))


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str,
    key_counts: DataFrame,
    parts: int | None = None,
) -> DataFrame:
    """Shuffle join that cuts each hot key into slices of about one task's share.

    A slice is a hash of the whole fact row, so a retried task puts it in the same
    place; facts should be free of exact copies. Lookup rows of hot keys are repeated
    once per slice. Facts without a key, which a left join keeps, are spread alike.
    Without hot keys this is a plain join.
    ``how`` is "inner" or "left".
    """
    spark = facts.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Bounded by hot_keys: fewer than `parts` rows of two numbers.
    hot = stage(hot_keys(key_counts, key, parts), "hot-keys")
    if hot.isEmpty():
        return facts.join(lookup, key, how)
    slices = F.when(F.col(key).isNull(), F.lit(parts)).otherwise(F.coalesce(F.col("_slices"), F.lit(1)))
    sliced = facts.join(F.broadcast(hot), key, "left").withColumn(
        "_slice", F.pmod(F.xxhash64(*facts.columns), slices).cast("int")
    )
    repeated = lookup.join(F.broadcast(hot), key, "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1))
    )
    return sliced.drop("_slices").join(repeated.drop("_slices"), [key, "_slice"], how).drop("_slice")
