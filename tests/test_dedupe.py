import random

from conftest import plan_of, tuples
from pyspark.sql import functions as F

from starledger.operators.complete import complete_rows
from starledger.operators.dedupe import keep_greatest, keep_latest


def _brute(rows, key, order):
    best = {}
    for row in rows:
        if key(row) not in best or order(row) > order(best[key(row)]):
            best[key(row)] = row
    return sorted(best.values(), key=repr)


def _rows(n=3000, seed=1):
    rng = random.Random(seed)
    # A third of the rows share one key.
    return [
        (0 if rng.random() < 0.34 else rng.randrange(40), rng.randrange(5), rng.randrange(50), float(rng.randrange(9)))
        for _ in range(n)
    ]


def test_keep_greatest_matches_brute_force(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "u long, i long, ts long, r double")
    assert tuples(keep_greatest(df, ["u", "i", "ts"])) == _brute(rows, lambda r: r[:3], lambda r: r[3])
    assert tuples(keep_greatest(df, ["u", "i"], ["ts"])) == _brute(rows, lambda r: r[:2], lambda r: r[2:])
    assert tuples(keep_greatest(df, ["u", "i"], ["r"])) == _brute(rows, lambda r: r[:2], lambda r: (r[3], r[2]))


def test_all_columns_as_keys_is_distinct(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "a long, b long")
    assert tuples(keep_greatest(df, ["a", "b"])) == [(1, 1), (2, 1)]


def test_keep_latest_matches_brute_force_on_unique_times(spark):
    rows = list({r[:3]: r for r in _rows()}.values())
    df = spark.createDataFrame(rows, "u long, i long, ts long, r double")
    assert tuples(keep_latest(df, ["u", "i"], "ts")) == _brute(rows, lambda r: r[:2], lambda r: r[2])


def test_dedupe_is_idempotent_and_ignores_partitioning(spark):
    df = spark.createDataFrame(_rows(), "u long, i long, ts long, r double")
    once = keep_greatest(df, ["u", "i"], ["ts"])
    assert tuples(keep_greatest(once, ["u", "i"], ["ts"])) == tuples(once)
    for parts in (1, 3, 8):
        assert tuples(keep_greatest(df.repartition(parts), ["u", "i"], ["ts"])) == tuples(once)


def test_numbers_stay_in_hash_aggregates(spark):
    df = spark.createDataFrame(_rows(10), "u long, i long, ts long, r double")
    for deduped in (keep_greatest(df, ["u", "i", "ts"]), keep_latest(df, ["u", "i"], "ts")):
        plan = plan_of(deduped)
        assert "partial_max" in plan and "SortAggregate" not in plan and "Window" not in plan


def test_complete_rows_drops_null_and_nan(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "a"), (None, 1.0, "a"), (2, None, "a"), (3, float("nan"), "a"), (4, 2.0, None)],
        "k long, x double, s string",
    )
    assert tuples(complete_rows(df, ["k", "x"])) == tuples(df.dropna(subset=["k", "x"]))
    assert tuples(complete_rows(df)) == [(1, 1.0, "a")]


def test_complete_rows_reaches_the_scan(spark, tmp_path):
    spark.range(5).select("id", F.col("id").cast("double").alias("x")).write.parquet(str(tmp_path / "t"))
    plan = plan_of(complete_rows(spark.read.parquet(str(tmp_path / "t")), ["id"]))
    assert "PushedFilters: [IsNotNull(id)]" in plan
