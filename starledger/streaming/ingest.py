"""Event stream to the raw (bronze) table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starledger.functions.events import epoch_to_text, parse_event
from starledger.schemas import EVENT_SCHEMA, from_wire, wire_schema


def kafka_options(servers: str, topic: str, **more: str) -> dict[str, str]:
    """Options of a Kafka source that reads a topic from its first record."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", **more}


def open_stream(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Any Structured Streaming source: ``kafka`` in production, files in tests."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def parse_events(raw: DataFrame, payload: str = "value") -> DataFrame:
    """Raw records to bronze rows. Bad records stay, with null fields."""
    events = from_wire(raw.select(parse_event(F.col(payload)).alias("event")).select("event.*"))
    return events.withColumn("rating_datetime", epoch_to_text(F.col("ts")))


def rejected_records(raw: DataFrame, payload: str = "value") -> DataFrame:
    """The text of records that lack a required field once parsed.

    The parsed event is named once, as an array of one, so that a filter pushed to the
    source parses each record once and not once per field.
    """
    return _rejects(raw, payload).select(F.col(payload).cast("string").alias("record"))


def dated_rejects(raw: DataFrame, time: str, payload: str = "value") -> DataFrame:
    """Rejected records with ``source_time``: the source's column named by ``time``."""
    return _rejects(raw, payload).select(
        F.col(payload).cast("string").alias("record"), F.col(time).cast("timestamp").alias("source_time")
    )


def _rejects(raw: DataFrame, payload: str) -> DataFrame:
    required = wire_schema(EVENT_SCHEMA).names
    incomplete = F.exists(
        F.array(parse_event(F.col(payload))),
        lambda event: reduce(lambda a, b: a | b, [event[name].isNull() for name in required]),
    )
    return raw.filter(incomplete)


def drop_replays(
    events: DataFrame, keys: Sequence[str], event_time: str, delay: str, lanes: int = 16
) -> DataFrame:
    """Streaming de-duplication with bounded state.

    A stream has no map-side combine before its state, so copies of one record would
    all meet in one task. They are first reduced within lanes, which follow the source
    partition, and then across lanes, where a record has at most ``lanes`` copies left
    per batch.

    Spark discards rows later than ``delay``, so this is for consumers of the stream.
    The bronze table keeps every record and cleaning removes all its replays.

    State holds each key of the last ``delay`` once, and once more for each lane that it
    arrived in. ``lanes=1`` leaves the first step out: least state and one shuffle, but all
    copies of a key meet in one task.
    """
    timed = events.withWatermark(event_time, delay)
    if lanes == 1:
        return timed.dropDuplicatesWithinWatermark(list(keys))
    timed = timed.withColumn("_lane", F.spark_partition_id() % lanes)
    within = timed.dropDuplicatesWithinWatermark([*keys, "_lane"]).drop("_lane")
    return within.dropDuplicatesWithinWatermark(list(keys))


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    once: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Append to a table, each batch exactly once; a restart resumes at the checkpoint.

    Runs for ever, unless ``once`` asks it to stop when the data present at the start has
    been read. A batch starts every ``interval`` ("5 minutes"), which keeps files large, or
    else as soon as the one before has ended.
    """
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if once:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start(path)
