"""Intermediate tables in the shared folder, and their removal after a job."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from starledger.plans import jobs
from starledger.session import GROUP_BYTES, TASK_BYTES, bound_tasks, stage, temporary_tables, workspace
from starledger.sources.tables import write_table


def _here(spark):
    return set(os.listdir(workspace(spark).removeprefix("file:")))


def test_staged_tables_go_when_the_block_ends(spark, tmp_path):
    outside = stage(spark.range(3), "outside")
    before = _here(spark)
    with temporary_tables(spark):
        rows = stage(spark.range(10).withColumn("x", F.col("id") % 3), "inside")
        with temporary_tables(spark):
            inner = stage(rows.groupBy("x").count(), "inner")
            assert inner.count() == 3 and len(_here(spark) - before) == 2
        assert len(_here(spark) - before) == 1
        write_table(rows, str(tmp_path / "result"))
    assert _here(spark) == before
    assert spark.read.parquet(str(tmp_path / "result")).count() == 10 and outside.count() == 3


def test_staged_tables_stay_after_an_error(spark):
    before = _here(spark)
    with pytest.raises(ValueError, match="stop"), temporary_tables(spark):
        kept = stage(spark.range(4), "kept")
        raise ValueError("stop")
    assert len(_here(spark) - before) == 1 and kept.count() == 4
    later = stage(spark.range(5), "later")  # no longer listed anywhere
    assert later.count() == 5


def test_tables_of_other_threads_stay(spark):
    made = []
    with temporary_tables(spark):
        thread = threading.Thread(target=lambda: made.append(stage(spark.range(6), "other-thread")))
        thread.start()
        thread.join()
    assert made[0].count() == 6


def test_a_job_leaves_its_results_alone(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path))
    (tmp_path / "events").mkdir()
    (tmp_path / "events" / "a.txt").write_text(
        "\n".join(f'{{"userId":{u},"movieId":{i},"rating":3.5,"timestamp":{1_600_000_000 + u * 50 + i}}}' for u in range(1, 9) for i in range(1, 6))
    )
    (tmp_path / "items.csv").write_text("movieId,title,genres\n" + "".join(f"{i},Title {i},A|B\n" for i in range(1, 6)))
    jobs.run_bronze(lake, "text", {}, str(tmp_path / "events"), once=True).awaitTermination()
    before = _here(spark)
    with temporary_tables(spark):
        jobs.run_silver(lake, str(tmp_path / "items.csv"))
        jobs.run_gold(lake)
        jobs.run_features(lake)
        assert _here(spark) > before
    assert _here(spark) == before
    assert lake.read(lake.enriched).count() == lake.read(lake.pairs).count() == lake.read(lake.features).count() == 40


def test_a_large_staged_file_is_read_by_many_tasks(spark):
    rows = spark.range(0, 4_000_000, numPartitions=1).select(F.rand(7).alias("x"))  # 32 MB, one file
    read = stage(rows, "large", GROUP_BYTES)
    each = [r["n"] for r in read.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(each) == 4_000_000 and 8 * max(each) <= TASK_BYTES + 2 * GROUP_BYTES


def test_settings_of_the_submitter_stay(spark):
    files, joined, dealt = (
        "spark.sql.files.maxPartitionBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
    )
    own = spark.newSession()
    own.conf.set(joined, "3m")
    own.conf.set("spark.sql.shuffle.partitions", "900")
    bound_tasks(own)
    assert own.conf.get(joined) == "3m" and own.conf.get(files) == str(TASK_BYTES) and own.conf.get(dealt) == "900"
