import json

from conftest import tuples
from pyspark.sql import functions as F

from starledger.functions.events import encode_event, epoch_to_text, epoch_to_timestamp, time_parts
from starledger.streaming.ingest import parse_events, rejected_records

GOOD = '{"userId":1,"movieId":2,"rating":3.5,"timestamp":1000000000}'
RECORDS = {
    GOOD: (1, 2, 3.5, 1000000000, "2001-09-09 01:46:40"),
    "not json": (None,) * 5,
    '{"userId":1}': (1, None, None, None, None),
    '{"userId":"x","movieId":2,"rating":1.0,"timestamp":5}': (None, 2, 1.0, 5, "1970-01-01 00:00:05"),
    '{"userId":99999999999999999999,"movieId":2,"rating":1.0,"timestamp":5}': (None, 2, 1.0, 5, "1970-01-01 00:00:05"),
    '{"userId":1,"movieId":2,"rating":1.0,"timestamp":9999999999}': (1, 2, 1.0, 9999999999, "2286-11-20 17:46:39"),
    "[]": (None,) * 5,
    "": (None,) * 5,
    "null": (None,) * 5,
}


def test_every_record_gives_one_row(spark):
    for record, expected in RECORDS.items():
        raw = spark.createDataFrame([(record,)], "value string")
        assert tuples(parse_events(raw)) == [expected], record


def test_bytes_parse_like_text(spark):
    raw = spark.createDataFrame([(bytearray(GOOD, "utf8"),)], "value binary")
    assert tuples(parse_events(raw)) == [RECORDS[GOOD]]


def test_null_payload_is_a_null_row_and_a_reject(spark):
    raw = spark.createDataFrame([(None,), (GOOD,)], "value string")
    assert tuples(parse_events(raw)) == sorted([(None,) * 5, RECORDS[GOOD]], key=repr)
    assert tuples(rejected_records(raw)) == [(None,)]


def test_rejects_are_the_records_with_a_null_field(spark):
    raw = spark.createDataFrame([(r,) for r in RECORDS], "value string")
    bad = sorted(r for r, row in RECORDS.items() if None in row)
    assert sorted(r[0] for r in rejected_records(raw).collect()) == bad


def test_rejects_parse_each_record_once(spark):
    plan = rejected_records(spark.range(3).select(F.col("id").cast("string").alias("value")))
    physical = plan._jdf.queryExecution().executedPlan().toString()
    assert physical.count("from_json") == 1


def test_encode_then_parse_is_the_identity(spark):
    rows = [(1, 2, 0.5, 7), (2147483648, 3, 4.25, 4102444800)]
    events = spark.createDataFrame(rows, "user_id long, item_id long, rating double, ts long")
    encoded = events.select(encode_event().alias("value"))
    assert json.loads(encoded.first()[0]) == {"userId": 1, "movieId": 2, "rating": 0.5, "timestamp": 7}
    assert tuples(parse_events(encoded).drop("rating_datetime")) == sorted(rows)


def test_epoch_text_and_timestamp_agree(spark):
    df = spark.createDataFrame([(0,), (828163431,), (1574195101,), (None,)], "ts long")
    row = df.select(
        epoch_to_text(F.col("ts")).alias("text"), epoch_to_timestamp(F.col("ts")).cast("string").alias("at")
    )
    assert all(r.text == r.at for r in row.collect())


def test_time_parts(spark):
    # 2024-02-29 23:59:59 UTC is a Thursday.
    df = spark.createDataFrame([(1709251199,)], "ts long")
    parts = df.select(*time_parts(epoch_to_timestamp(F.col("ts"))).values()).first()
    assert tuple(parts) == (2024, 2, 5, 23)
