from pyspark.sql import functions as F

from starledger.functions.tags import main_tag, split_tags, tag_count


def test_split(spark):
    df = spark.createDataFrame([("A|B|C",), ("A",), ("",), (None,), (" A | B",)], "tags string")
    got = [r[0] for r in df.select(split_tags(F.col("tags"))).collect()]
    assert got == [["A", "B", "C"], ["A"], [""], None, [" A ", " B"]]
    assert df.select(split_tags(F.col("tags"), trim=True)).collect()[4][0] == ["A", "B"]


def test_count(spark):
    df = spark.createDataFrame([(["A", "B"],), ([],), (None,)], "t array<string>")
    assert [r[0] for r in df.select(tag_count(F.col("t"))).collect()] == [2, 0, None]


def test_main_tag_is_most_frequent_then_earliest(spark):
    cases = [
        (["A", "B", "C"], "A"),
        (["Z", "A"], "Z"),
        (["A", "B", "B"], "B"),
        (["C", "B", "A", "B", "A"], "B"),
        ([], None),
        (None, None),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "t array<string>")
    assert [r[0] for r in df.select(main_tag(F.col("t"))).collect()] == [c[1] for c in cases]
