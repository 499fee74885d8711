"""Every named query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, str(TABLES))
    want = duck.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert _rows(df.columns, df.collect()) == _rows(want.columns, want.fetchall())
    plan = df._jdf.queryExecution().toString()
    for unwanted in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert queries()[name](spark, str(TABLES)).count() > 0


def test_results_do_not_depend_on_the_time_zone_found(spark, duck):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    for name in ("time_features", "epoch_to_datetime", "clean_ratings"):
        df = queries()[name](spark, str(TABLES))
        want = duck.sql(oracle_sql()[name])
        assert _rows(df.columns, df.collect()) == _rows(want.columns, want.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_its_query():
    assert set(oracle_sql()) <= set(queries())


def test_coverage_lists_every_query():
    text = (Path(__file__).parent.parent / "COVERAGE.md").read_text()
    assert [name for name in queries() if name not in text] == []
