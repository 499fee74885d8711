"""Category indices by frequency."""

import subprocess
import sys
from pathlib import Path

from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from starledger.operators.categories import frequency_index, with_index


def test_index_is_that_of_mllib(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 11 > 0, F.concat(F.lit("c"), (F.col("id") * F.col("id") % 97).cast("string"))).alias("tag"))
    train = df.filter("tag <> 'c1'")
    theirs = StringIndexer(inputCol="tag", outputCol="i", handleInvalid="keep").fit(train).transform(df)
    ours = with_index(df, frequency_index(train, "tag"), "tag", "i")
    assert ours.columns == ["tag", "i"] and ours.exceptAll(theirs).isEmpty() and ours.count() == 4000


def test_empty_tables_and_nulls(spark):
    df = spark.createDataFrame([(None,), ("a",)], "tag string")
    none = frequency_index(df.limit(0), "tag")
    assert none.isEmpty()
    assert {(r.tag, r.i) for r in with_index(df, none, "tag", "i").collect()} == {(None, 0.0), ("a", 0.0)}


_MANY = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from starledger.operators.categories import frequency_index
from starledger.session import build_session

spark = build_session("many", "local[4]", **{{
    "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.maxResultSize": "256k",
    "spark.checkpoint.dir": {shared!r},
}})
spark.sparkContext.setLogLevel("OFF")
df = spark.range(3_000_000).select(F.concat(F.lit("label "), (F.col("id") % 2_000_000).cast("string")).alias("tag"))
index = frequency_index(df, "tag")
n, least, most, distinct, often = index.agg(
    F.count("*"), F.min("index"), F.max("index"), F.sum("index"), F.count_if((F.col("index") < 1_000_000) == (F.col("n") == 2))
).first()
print("FOUND", n, least, most, distinct == 1_999_999 * 1_000_000, often)
"""


def test_two_million_labels_never_meet_on_the_driver(tmp_path):
    """All results that reach the driver together may take 256 kB, a hundredth of the labels."""
    code = _MANY.format(repo=str(Path(__file__).parent.parent), shared=str(tmp_path))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600)
    assert "FOUND 2000000 0.0 1999999.0 True 2000000" in done.stdout, done.stderr[-2000:]
