import pytest
from conftest import tuples
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from starledger import session
from starledger.schemas import ITEM_SCHEMA, from_wire, to_wire, wire_slot
from starledger.sources.tables import is_empty, read_items_and_rejects, read_items_csv, read_table, safe_read_table, write_table


def test_missing_and_empty_folders_read_as_empty_tables(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for name in ("missing", "empty"):
        df = safe_read_table(spark, str(tmp_path / name), ITEM_SCHEMA)
        assert df.schema == ITEM_SCHEMA and is_empty(df)


def test_other_errors_are_not_hidden(spark, tmp_path):
    with pytest.raises(AnalysisException):
        safe_read_table(spark, str(tmp_path), ITEM_SCHEMA, fmt="text").select("no_such_column")


def test_overwrite_replaces_rows_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    write_table(spark.range(2).select(F.col("id").alias("other"), F.lit("x").alias("s")), path, replace_schema=True)
    assert tuples(read_table(spark, path)) == [(0, "x"), (1, "x")]


def test_append_and_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        write_table(spark.range(3).withColumn("p", F.col("id") % 2), path, mode="append", partition_by=["p"])
    assert read_table(spark, path).count() == 6


def test_item_csv(spark, tmp_path):
    text = 'movieId,title,genres\n1,"One, ""the"" first",A|B\n2,Two,\nx,Bad,A\n'
    (tmp_path / "items.csv").write_text(text)
    assert tuples(read_items_csv(spark, str(tmp_path / "items.csv"))) == sorted(
        [(1, 'One, "the" first', "A|B"), (2, "Two", None), (None, "Bad", "A")], key=repr
    )


def test_wire_names_round_trip(spark):
    df = spark.createDataFrame([(1, 2, 3.0, 4)], "user_id long, item_id long, rating double, ts long")
    assert to_wire(df).columns == ["userId", "movieId", "rating", "timestamp"]
    assert from_wire(to_wire(df)).columns == df.columns
    assert [wire_slot(s) for s in ("tag_count", "rating_hour", "main_tag_vec_A")] == [
        "genre_count",
        "rating_hour",
        "main_genre_vec_A",
    ]


def test_workspace_is_the_folder_the_session_names(spark, monkeypatch):
    assert session.workspace(spark) == session.workspace(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert session.workspace(spark) == named


def test_a_cluster_must_name_its_folder():
    class Nameless:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.workspace(Nameless)


def test_stage_keeps_rows_schema_and_metadata(spark):
    df = spark.range(3).withColumn("x", F.array(F.lit("a"))).withMetadata("x", {"note": "kept"})
    staged = session.stage(df, "test")
    assert tuples(staged) == tuples(df)
    assert staged.schema["x"].metadata == {"note": "kept"}


def test_item_file_is_read_by_header_name(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text("genres,extra,title,movieId\nA|B,z,first,1\nC,z,second,x\n")
    rows = read_items_csv(spark, str(path)).collect()
    assert [(r.item_id, r.title, r.tags) for r in rows] == [(1, "first", "A|B"), (None, "second", "C")]
    path.write_text("title,movieId\nfirst,1\n")
    with pytest.raises(ValueError, match="genres"):
        read_items_csv(spark, str(path))


def _items_and_rejects(spark, path, text, multiline=False):
    path.write_text(text)
    items, rejects = read_items_and_rejects(spark, str(path), multiline)
    return tuples(items), tuples(rejects)


def test_item_csv_rejects(spark, tmp_path):
    text = (
        'movieId,extra,title,genres\n1,e,"One, ""the"" first",A|B\n2,e,Two,\n'
        'x,e,Bad,A\n4,e\n5,e,"Torn,A\n6,e,Six,B,more\n,e,Nameless,A\n8,e,,A\n9,e,Nine,C\n'
    )
    items, rejects = _items_and_rejects(spark, tmp_path / "i.csv", text)
    assert items == sorted([(1, 'One, "the" first', "A|B"), (2, "Two", None), (9, "Nine", "C")], key=repr)
    assert rejects == sorted(
        [
            ("unreadable", "x,e,Bad,A"),
            ("unreadable", "4,e"),
            ("unreadable", '5,e,"Torn,A'),
            ("unreadable", "6,e,Six,B,more"),
            ("incomplete", ",e,Nameless,A"),
            ("incomplete", "8,e,,A"),
        ],
        key=repr,
    )


def test_item_csv_with_line_breaks(spark, tmp_path):
    text = 'movieId,title,genres\n1,"One\nmore",A\n2,Two,B\nx,"Bad\nid",A\n3,"Torn,C\n4,Four,D\n'
    items, rejects = _items_and_rejects(spark, tmp_path / "i.csv", text, multiline=True)
    assert items == [(1, "One\nmore", "A"), (2, "Two", "B")]
    assert [reason for reason, _ in rejects] == ["unreadable", "unreadable"]
    whole = "".join(record for _, record in rejects)
    assert "Bad\nid" in whole and "Torn" in whole and "Four" in whole


def test_item_csv_of_a_header_alone(spark, tmp_path):
    assert _items_and_rejects(spark, tmp_path / "i.csv", "genres,movieId,title\n") == ([], [])
    with pytest.raises(ValueError, match="title"):
        _items_and_rejects(spark, tmp_path / "j.csv", "movieId,genres\n1,A\n")
