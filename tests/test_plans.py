"""Shuffles and scans of the main queries, so that a change that adds one is noticed."""

from pathlib import Path

import pytest

from __spark_entry__ import queries
from starledger.operators.sampling import hash_sample

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no test tables here")

# Hash shuffles. Each has one that de-duplicates items, and one that de-duplicates
# ratings unless only distinct keys of them are needed.
SHUFFLES = {
    "clean_ratings": 1,
    "enrich_silver": 2,
    "most_rated": 3,
    "genre_stats": 4,
    "user_activity": 3,
    "ml_dataset": 3,
    "kpis": 4,
    "rating_distribution": 1,
    "user_features": 3,
    "item_features": 3,
    "main_genre": 2,
}


def _plan(spark, name):
    return queries()[name](spark, str(TABLES))._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(SHUFFLES))
def test_hash_shuffles(spark, name):
    assert _plan(spark, name).count("Exchange hashpartitioning") == SHUFFLES[name]


def test_aggregates_combine_before_the_shuffle(spark):
    for name in ("most_rated", "genre_stats", "user_activity", "ml_dataset"):
        lines = _plan(spark, name).splitlines()
        for i, line in enumerate(lines):
            if "Exchange hashpartitioning" in line:
                assert "partial" in lines[i + 1] or "HashAggregate" in lines[i + 1], lines[i + 1]


def test_scans_read_the_columns_needed(spark):
    plan = _plan(spark, "rating_distribution")
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_top_n_does_not_sort_everything(spark):
    for name in ("top_n_items", "top_n_users", "top_rated_min_n"):
        plan = _plan(spark, name)
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_sample_scans_its_table_twice(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    sample = hash_sample(spark.read.parquet(str(tmp_path / "t")), ["id"], 10)
    assert sample._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
