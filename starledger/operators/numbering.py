"""Dense numbers for rows and for keys, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.session import stage

#: Bits that ``monotonically_increasing_id`` leaves for the row within its partition.
_ROW_BITS = (1 << 33) - 1


def number_rows(df: DataFrame, name: str = "number", label: str = "numbered") -> DataFrame:
    """``df`` with the numbers 0 .. rows - 1 in the order of its partitions and their rows.

    Rows are written once with their partition and place, so the numbers are fixed whatever
    happens to executors later. A partition's offset is the sum of the sizes before it; what
    is collected and broadcast is one number per partition.
    """
    spark = df.sparkSession
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))
    placed = stage(df.select("*", F.spark_partition_id().alias("_part"), place.alias("_place")), label)
    sizes = sorted((r["_part"], r["n"]) for r in placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], 0
    for part, n in sizes:
        offsets.append((part, total))
        total += n
    starts = F.broadcast(spark.createDataFrame(offsets, "_part int, _start bigint"))
    return placed.join(starts, "_part").select(*df.columns, (F.col("_start") + F.col("_place")).alias(name))


def dense_ids(df: DataFrame, key: str, name: str = "number") -> DataFrame:
    """(key, number): the distinct values of ``key``, numbered from 0 in ascending order.

    Keys are dealt by range and sorted within their range; nulls get no number.
    """
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    ranged = keys.repartitionByRange(key).sortWithinPartitions(key)
    return stage(number_rows(ranged, name, "dense-placed"), "dense-ids")
