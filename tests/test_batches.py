"""Batch sinks: exactly once after a failure, late rows kept apart, state read back."""

from datetime import datetime, timedelta

import pytest
from conftest import tuples
from pyspark.errors import StreamingQueryException

from starledger.streaming import batches, ingest

START = datetime(2024, 1, 1)
SCHEMA = "k long, v long, at timestamp"


def _add(spark, folder, rows):
    data = [(k, v, None if hours is None else START + timedelta(hours=hours)) for k, v, hours in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(2).write.mode("append").parquet(str(folder))


def _run(spark, folder, checkpoint, write):
    stream = ingest.open_stream(spark, "parquet", path=str(folder), schema=spark.read.parquet(str(folder)).schema)
    batches.each_batch(stream, str(checkpoint), write, once=True).awaitTermination()


def _kv(table):
    return sorted((r.k, r.v) for r in table.select("k", "v").collect())


def test_a_batch_that_fails_after_its_write_is_replaced(spark, tmp_path):
    sink, failures = batches.replace_batch(str(tmp_path / "out")), [1]

    def fails_in(rows, stream, batch):
        sink(rows, stream, batch)
        if batch in failures:
            failures.remove(batch)
            raise RuntimeError("lost after the write")

    want = []
    for n in range(3):
        rows = [(k, n, k) for k in range(10)]
        want += rows
        _add(spark, tmp_path / "in", rows)
        try:
            _run(spark, tmp_path / "in", tmp_path / "cp", fails_in)
        except StreamingQueryException:
            assert n == 1
            _run(spark, tmp_path / "in", tmp_path / "cp", fails_in)
    assert not failures
    table = spark.read.parquet(str(tmp_path / "out"))
    assert _kv(table) == sorted((k, v) for k, v, _ in want)
    assert tuples(table.groupBy("batch").count()) == [(0, 10), (1, 10), (2, 10)]
    assert table.select("stream").distinct().count() == 1


def test_two_streams_into_one_table(spark, tmp_path):
    for name in ("a", "b"):
        _add(spark, tmp_path / name, [(1, 1, 0)])
        _run(spark, tmp_path / name, tmp_path / f"cp-{name}", batches.replace_batch(str(tmp_path / "out")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def _python_late(runs, delay):
    """Plain-Python rule of ``keep_late`` with the key k, times in hours."""
    kept, late, lines, newest = [], [], [], None
    for batch, rows in enumerate(runs):
        mark = None if newest is None else newest - delay
        fresh = {}
        n_late = 0
        for k, v, t in rows:
            if mark is not None and t is not None and t < mark:
                late.append((k, v))
                n_late += 1
                continue
            old = fresh.get(k)
            order = lambda row: (row[0], row[1] is not None, row[1] or 0)
            if old is None or order((v, t)) > order(old):
                fresh[k] = (v, t)
        known = {k for k, _, t, b in kept if mark is None or t is None or t >= mark - delay}
        added = [(k, v, t, batch) for k, (v, t) in fresh.items() if k not in known]
        kept += added
        lines.append((len(rows), len(added), n_late))
        times = [t for *_, t in rows if t is not None]
        newest = max([newest, *times], key=lambda t: float("-inf") if t is None else t) if times else newest
    return sorted((k, v) for k, v, *_ in kept), sorted(late), lines


def test_late_rows_are_set_aside_and_counted(spark, tmp_path):
    runs = [
        [(1, 1, 0), (1, 2, 0), (2, 1, 5), (7, 7, 100)],
        [(1, 9, 0), (3, 1, 95), (7, 8, 99), (4, 1, 89), (4, 2, 90), (8, 1, None)],
        [(3, 2, 130), (5, 1, 200), (6, 1, 89)],
        [(7, 9, 195), (2, 5, 250), (5, 2, 199), (9, 1, 189)],
        [(2, 6, 1), (10, 1, 2)],
    ]
    for rows in runs:
        _add(spark, tmp_path / "in", rows)
        _run(spark, tmp_path / "in", tmp_path / "cp", batches.keep_late(str(tmp_path / "t"), ["k"], "at", "10 hours"))
    kept, late, lines = _python_late(runs, 10)
    assert _kv(spark.read.parquet(str(tmp_path / "t" / "kept"))) == kept
    assert _kv(spark.read.parquet(str(tmp_path / "t" / "late"))) == late
    ledger = spark.read.schema(batches.LEDGER_SCHEMA).parquet(str(tmp_path / "t" / "batches")).orderBy("batch").collect()
    assert [(r.records, r.kept, r.late) for r in ledger] == lines
    assert all(r.kept + r.late + r.replayed == r.records for r in ledger)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    write = batches.keep_late(str(tmp_path / "t"), ["k"], "at", "1 hour")
    rows = [spark.createDataFrame([(k, n, START + timedelta(hours=3 * n)) for k in range(5)], SCHEMA) for n in range(3)]
    for n in range(3):
        write(rows[n], "s", n)
        write(rows[n], "s", n)
    kept = spark.read.parquet(str(tmp_path / "t" / "kept"))
    first = tuples(kept.select("k", "v", "at", "batch"))
    write(rows[2], "s", 2)
    assert tuples(spark.read.parquet(str(tmp_path / "t" / "kept")).select("k", "v", "at", "batch")) == first


def test_a_key_that_most_rows_have_and_null_keys(spark, tmp_path):
    write = batches.keep_late(str(tmp_path / "t"), ["k"], "at", "1 hour")
    for n in range(2):
        rows = [(1, n, START)] * 500 + [(None, n, START)] * 3
        write(spark.createDataFrame(rows, SCHEMA), "s", n)
    write(spark.createDataFrame([], SCHEMA), "s", 2)
    assert tuples(spark.read.parquet(str(tmp_path / "t" / "kept")).select("k", "v")) == [(1, 0), (None, 0)]


def test_state_holds_each_key_once(spark, tmp_path):
    _add(spark, tmp_path / "in", [(k % 7, 0, 1) for k in range(50)])
    stream = ingest.open_stream(spark, "parquet", path=str(tmp_path / "in"), schema=spark.read.parquet(str(tmp_path / "in")).schema)
    once = ingest.drop_replays(stream, ["k"], "at", "1 day", lanes=1)
    ingest.append_stream(once, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    state = batches.state_rows(spark, str(tmp_path / "cp"))
    assert sorted(r.k for r in state.collect()) == list(range(7))


def test_an_unreadable_delay_is_an_error(spark, tmp_path):
    write = batches.keep_late(str(tmp_path / "t"), ["k"], "at", "soon")
    with pytest.raises(Exception, match="INTERVAL|interval|soon"):
        write(spark.createDataFrame([(1, 1, START)], SCHEMA), "s", 0)
