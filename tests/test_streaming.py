from conftest import tuples
from pyspark.sql import functions as F

from starledger.plans import jobs, silver
from starledger.streaming import ingest


def _record(user, item, rating, ts):
    return f'{{"userId":{user},"movieId":{item},"rating":{rating},"timestamp":{ts}}}'


def _put(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(records) + "\n")


def _run(spark, folder, out, checkpoint):
    stream = ingest.parse_events(ingest.open_stream(spark, "text", path=str(folder)))
    query = ingest.append_stream(stream, str(out), str(checkpoint), once=True)
    query.awaitTermination()
    return spark.read.parquet(str(out))


def test_restart_reads_only_what_is_new(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "cp"
    first = [_record(1, n, 1.5, n) for n in range(10)]
    _put(source, "a.txt", first)
    assert _run(spark, source, out, checkpoint).count() == 10
    assert _run(spark, source, out, checkpoint).count() == 10
    _put(source, "b.txt", [_record(2, 1, 4.0, 99), "broken"])
    rows = _run(spark, source, out, checkpoint)
    assert rows.count() == 12
    assert rows.filter("user_id is null").count() == 1


def test_replayed_file_doubles_bronze_and_leaves_silver_alone(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "cp"
    records = [_record(1, n, 1.5, n) for n in range(10)]
    _put(source, "a.txt", records)
    once = tuples(silver.clean_ratings(_run(spark, source, out, checkpoint)))
    _put(source, "b.txt", records)
    bronze = _run(spark, source, out, checkpoint)
    assert bronze.count() == 20
    assert tuples(silver.clean_ratings(bronze)) == once


def test_partitioned_append(spark, tmp_path):
    _put(tmp_path / "in", "a.txt", [_record(1, 1, 1.0, 0), _record(1, 1, 1.0, 86400)])
    stream = ingest.parse_events(ingest.open_stream(spark, "text", path=str(tmp_path / "in")))
    dated = stream.withColumn("day", F.substring("rating_datetime", 1, 10))
    out = str(tmp_path / "out")
    ingest.append_stream(dated, out, str(tmp_path / "cp"), partition_by=["day"], once=True).awaitTermination()
    assert sorted(p.name for p in (tmp_path / "out").glob("day=*")) == ["day=1970-01-01", "day=1970-01-02"]


def test_stream_deduplication_spans_batches(spark, tmp_path):
    source = tmp_path / "in"
    _put(source, "a.txt", [_record(1, n, 1.5, 1000 + n) for n in range(10)])

    def run():
        stream = ingest.parse_events(ingest.open_stream(spark, "text", path=str(source)))
        timed = stream.withColumn("at", F.timestamp_seconds("ts"))
        unique = ingest.drop_replays(timed, ["user_id", "item_id", "ts"], "at", "1 hour")
        query = ingest.append_stream(unique, str(tmp_path / "out"), str(tmp_path / "cp"), once=True)
        query.awaitTermination()
        return spark.read.parquet(str(tmp_path / "out")).count()

    assert run() == 10
    _put(source, "b.txt", [_record(1, n, 1.5, 1000 + n) for n in range(5, 15)])
    assert run() == 15


def test_stream_deduplication_of_many_copies(spark, tmp_path):
    """A record that makes up most of the stream, spread over files, stays once."""
    source = tmp_path / "in"
    for n in range(12):
        _put(source, f"{n}.txt", [_record(7, 7, 1.0, 5000)] * 50 + [_record(n, 1, 1.0, 5000 + n)])
    raw = ingest.open_stream(spark, "text", {"maxFilesPerTrigger": "5"}, path=str(source))
    timed = ingest.parse_events(raw).withColumn("at", F.timestamp_seconds("ts"))
    unique = ingest.drop_replays(timed, ["user_id", "item_id", "ts"], "at", "1 hour")
    ingest.append_stream(unique, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.count() == 13 and rows.filter("user_id = 7 and item_id = 7").count() == 1


def test_kafka_options():
    options = ingest.kafka_options("host:1", "topic", maxOffsetsPerTrigger="5")
    assert options == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "topic",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5",
    }


def test_rejects_keep_text_and_time_and_restart_adds_nothing(spark, tmp_path):
    _put(tmp_path / "in", "a.txt", [_record(1, 1, 1.0, 0), "broken", '{"userId":1}'])
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    for _ in range(2):
        for start in (jobs.run_bronze, jobs.run_rejects):
            start(lake, "text", {}, str(tmp_path / "in"), once=True).awaitTermination()
    rejects = spark.read.parquet(lake.path(lake.rejects))
    assert sorted(r.record for r in rejects.collect()) == ["broken", '{"userId":1}']
    assert rejects.filter("source_time IS NULL").isEmpty()
    assert lake.read(lake.bronze).count() == 3


def test_bronze_by_date_at_intervals_is_read_as_before(spark, tmp_path):
    _put(tmp_path / "in", "a.txt", [_record(1, n, 1.0, n) for n in range(5)])
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    query = jobs.run_bronze(lake, "text", {}, str(tmp_path / "in"), interval="1 second", by_date=True)
    query.processAllAvailable()
    query.stop()
    bronze = lake.read(lake.bronze)
    assert bronze.select("ingest_date").distinct().count() == 1
    assert silver.clean_ratings(bronze).count() == 5


def test_compacted_bronze_gives_the_same_silver(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    (tmp_path / "items.csv").write_text("movieId,title,genres\n1,One,A\n2,Two,B\nx,Bad,C\n")
    for n in range(3):
        _put(tmp_path / "in", f"{n}.txt", [_record(u, u % 2 + 1, 1.0, n) for u in range(20)])
        jobs.run_bronze(lake, "text", {}, str(tmp_path / "in"), once=True, by_date=True).awaitTermination()
    jobs.run_silver(lake, str(tmp_path / "items.csv"))
    before = tuples(lake.read(lake.enriched).select("user_id", "item_id", "rating", "ts"))
    assert len(before) == 60
    assert tuples(lake.read(lake.item_rejects)) == [("unreadable", "x,Bad,C")]
    assert jobs.run_compact(lake).isEmpty()  # today is still open
    plan = jobs.run_compact(lake, before="2999-01-01").collect()
    assert [(r.rows, r.files_planned) for r in plan] == [(60, 1)] and plan[0].files == 3
    jobs.run_silver(lake, str(tmp_path / "items.csv"))
    assert tuples(lake.read(lake.enriched).select("user_id", "item_id", "rating", "ts")) == before


def test_one_lane_is_one_state_operator(spark, tmp_path):
    _put(tmp_path / "in", "a.txt", [_record(1, 1, 1.0, 5000)] * 3)
    counts = {}
    for lanes in (1, 4):
        events = ingest.parse_events(ingest.open_stream(spark, "text", path=str(tmp_path / "in")))
        timed = events.withColumn("at", F.timestamp_seconds("ts"))
        once = ingest.drop_replays(timed, ["user_id", "item_id", "ts"], "at", "1 hour", lanes=lanes)
        query = ingest.append_stream(once, str(tmp_path / f"out{lanes}"), str(tmp_path / f"cp{lanes}"), once=True)
        query.awaitTermination()
        assert spark.read.parquet(str(tmp_path / f"out{lanes}")).count() == 1
        counts[lanes] = max(len(p["stateOperators"]) for p in query.recentProgress)
    assert counts == {1: 1, 4: 2}
