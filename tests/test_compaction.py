from conftest import tuples
from pyspark.sql import functions as F

from starledger.sources import compaction
from starledger.sources.compaction import compact_days, read_days


def _bronze(spark, path, rows=2000, days=4, parts=6):
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % days).cast("int"))
    table = spark.range(rows).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"), day.alias("day"))
    table.repartition(parts).write.partitionBy("day").parquet(path)


def _files(folder, day):
    return len(list((folder / f"day={day}").glob("*.parquet")))


def test_closed_days_get_the_planned_files_and_equal_rows(spark, tmp_path):
    path, into = str(tmp_path / "a"), str(tmp_path / "b")
    _bronze(spark, path)
    before = tuples(spark.read.parquet(path))
    plan = compact_days(spark, path, into, "day", before="2024-01-04", target_bytes=20_000).collect()
    assert {str(r.day) for r in plan} == {"2024-01-01", "2024-01-02"} and all(r.files == 6 for r in plan)
    for r in plan:
        assert r.files_planned == -(-r.bytes // 20_000) == _files(tmp_path / "b", r.day)
    assert max(r.files_planned for r in plan) > 1
    assert tuples(read_days(spark, path, into, "day")) == before
    assert _files(tmp_path / "b", "2024-01-04") == 0


def test_a_second_run_does_nothing_and_a_broken_day_is_done_again(spark, tmp_path):
    path, into = str(tmp_path / "a"), str(tmp_path / "b")
    _bronze(spark, path)
    before = tuples(spark.read.parquet(path))
    compact_days(spark, path, into, "day", before="2025-01-01")
    assert compact_days(spark, path, into, "day", before="2025-01-01").isEmpty()
    # As after a crash between two folders: one day holds only part of its rows.
    part = spark.read.parquet(into).filter("day = '2024-01-02' AND id % 3 = 0")
    kept = part.collect()
    again = spark.createDataFrame(kept, part.schema)
    again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(into)
    assert tuples(read_days(spark, path, into, "day")) == before
    redone = compact_days(spark, path, into, "day", before="2025-01-01").collect()
    assert [str(r.day) for r in redone] == ["2024-01-02"]
    assert tuples(spark.read.parquet(into).select("id", "x", F.col("day"))) == before


def test_nothing_compacted_yet_and_rows_that_come_late(spark, tmp_path):
    path, into = str(tmp_path / "a"), str(tmp_path / "b")
    _bronze(spark, path)
    assert read_days(spark, path, into, "day").count() == 2000
    compact_days(spark, path, into, "day", before="2025-01-01")
    spark.range(2000, 2010).select("id", F.lit("late").alias("x"), F.lit("2024-01-01").cast("date").alias("day")).write.mode(
        "append"
    ).partitionBy("day").parquet(path)
    assert read_days(spark, path, into, "day").count() == 2010
    compact_days(spark, path, into, "day", before="2025-01-01")
    assert spark.read.parquet(into).count() == 2010


def test_exact_copies_of_a_row_are_dealt_over_all_files(spark, tmp_path):
    path, into = str(tmp_path / "a"), str(tmp_path / "b")
    same = spark.range(3000).select(F.lit(1).alias("id"), F.lit("2024-01-01").cast("date").alias("day"))
    same.repartition(3).write.partitionBy("day").parquet(path)
    size = compaction.day_sizes(spark, path, "day").first().bytes
    compact_days(spark, path, into, "day", before="2025-01-01", target_bytes=size // 4 + 1)
    files = spark.read.parquet(into).groupBy(F.col("_metadata.file_path").alias("f")).count().collect()
    assert len(files) == 4 and min(r["count"] for r in files) > 600
