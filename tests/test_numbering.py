"""Dense numbers for rows and keys."""

from pyspark.sql import functions as F

from starledger.operators.numbering import dense_ids, number_rows


def test_rows_get_every_number_once(spark):
    df = spark.range(1000).repartition(7).withColumn("_part_of", F.col("id") % 3)
    got = number_rows(df)
    assert got.columns == ["id", "_part_of", "number"]
    assert sorted(r.number for r in got.collect()) == list(range(1000))


def test_keys_are_numbered_in_order_and_once(spark):
    df = spark.range(5000).select((F.col("id") % 700 * 10**12 - 5).alias("k")).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k"))
    got = {r.k: r.number for r in dense_ids(df.repartition(5), "k").collect()}
    assert got == {k * 10**12 - 5: k for k in range(700)}


def test_text_keys_and_empty_tables(spark):
    got = {r.k: r.number for r in dense_ids(spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "k string"), "k").collect()}
    assert got == {"a": 0, "b": 1}
    assert dense_ids(spark.createDataFrame([], "k string"), "k").isEmpty()
    assert number_rows(spark.createDataFrame([], "k string")).isEmpty()
