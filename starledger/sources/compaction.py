"""Small files of a table by day, rewritten to files of a planned size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starledger.operators.joins import lookup_join
from starledger.session import stage
from starledger.sources.tables import read_table, safe_read_table

TARGET_BYTES = 256 << 20


def day_sizes(spark: SparkSession, path: str, day: str) -> DataFrame:
    """Files and bytes of each day, from the file listing; no file is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return listed.groupBy(F.col(day).cast("date").alias(day)).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def _day_rows(table: DataFrame, day: str, name: str) -> DataFrame:
    """Rows of each day; only file footers are read."""
    return table.groupBy(F.col(day).cast("date").alias(day)).agg(F.count(F.lit(1)).alias(name))


def _plan(spark: SparkSession, path: str, into: str, day: str, before: str, target_bytes: int) -> DataFrame:
    source = spark.read.parquet(path)
    there = safe_read_table(spark, into, T.StructType([T.StructField(day, T.DateType())]))
    planned = day_sizes(spark, path, day).join(_day_rows(source, day, "rows"), day)
    planned = planned.join(_day_rows(there, day, "rows_there"), day, "left")
    planned = planned.filter((F.col(day) < F.lit(before).cast("date")) & ~F.col("rows").eqNullSafe(F.col("rows_there")))
    return planned.select(
        day, "rows", "bytes", "files", F.ceil(F.col("bytes") / target_bytes).cast("int").alias("files_planned")
    )


def compact_days(
    spark: SparkSession, path: str, into: str, day: str, before: str, target_bytes: int = TARGET_BYTES
) -> DataFrame:
    """Rewrite the closed days of a Parquet table, those before ``before``, into ``into``.

    Each day becomes ceil(bytes / target_bytes) files, where rows are dealt by their place in
    the old files: evenly, however large a day is, and alike when a task is repeated. A day
    is finished when both tables have equally many rows of it; finished days are left out,
    so the job can be ended at any time and run again. Returns the days rewritten with rows,
    bytes, files and planned files. ``read_days`` reads the result. Days without a value stay.
    """
    # One row per day: a window over all of them is small at any size of table.
    first = F.sum("files_planned").over(Window.orderBy(day)) - F.col("files_planned")
    plan = stage(_plan(spark, path, into, day, before, target_bytes).withColumn("first", first), "compaction")
    days = [row[0] for row in plan.select(day).collect()]
    if days:
        source = spark.read.parquet(path)
        place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
        placed = source.filter(F.col(day).cast("date").isin(days)).withColumn("_place", place)
        placed = placed.withColumn(day, F.col(day).cast("date"))
        deal = plan.select(day, F.col("files_planned").alias("_files"), F.col("first").alias("_first"))
        dealt = lookup_join(placed, deal, day, key_counts=plan.select(day, F.col("rows").alias("n")))
        file = (F.col("_first") + F.pmod("_place", F.col("_files"))).cast("int")
        count = plan.agg(F.sum("files_planned")).first()[0]
        dealt.repartitionById(count, file).select(*source.columns).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(day).parquet(into)
    return plan.drop("first")


def read_days(spark: SparkSession, path: str, into: str, day: str) -> DataFrame:
    """The whole table in plain names: finished days from ``into``, all others from ``path``."""
    source = read_table(spark, path)
    source = source.withColumn(day, F.col(day).cast("date"))
    there = safe_read_table(spark, into, source.schema).select(*source.columns)
    finished = _day_rows(source, day, "rows").join(_day_rows(there, day, "there"), day)
    days = [row[0] for row in finished.filter("rows = there").select(day).collect()]
    if not days:
        return source
    open_days = source.filter(F.col(day).isNull() | ~F.col(day).isin(days))
    return there.filter(F.col(day).isin(days)).unionByName(open_days)
