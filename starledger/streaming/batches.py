"""Batch by batch: any sink exactly once, and replay removal that loses no late row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starledger.operators.dedupe import keep_greatest
from starledger.sources.tables import safe_read_table

#: Called with a batch's rows, the stream's id and the batch's number.
Write = Callable[[DataFrame, str, int], None]

# Times are microseconds since the epoch. ``newest`` is of this batch alone.
LEDGER_SCHEMA = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("records", "kept", "late", "replayed", "newest")]
    + [T.StructField("stream", T.StringType()), T.StructField("batch", T.LongType())]
)


def each_batch(
    df: DataFrame, checkpoint: str, write: Write, once: bool = False, interval: str | None = None
) -> StreamingQuery:
    """Hand every batch to ``write``, for sinks that Spark cannot append to exactly once.

    Spark repeats a batch, with the same rows and number, when its call failed or its end
    was not recorded. ``write`` must then replace what it wrote for this stream and batch,
    as ``replace_batch`` does. The stream's id is that of its checkpoint, so it stays the
    same over restarts and keeps several streams into one table apart.
    """

    def call(rows: DataFrame, batch: int) -> None:
        write(rows, rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"), batch)

    writer = df.writeStream.foreachBatch(call).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def replace_batch(path: str, fmt: str = "parquet") -> Write:
    """A sink for any table format that can overwrite partitions.

    Rows get the columns ``stream`` and ``batch``, which partition the table; a repeated
    batch replaces its own partition and no other.
    """

    def write(rows: DataFrame, stream: str, batch: int) -> None:
        _replace(rows, path, stream, batch, fmt)

    return write


def _replace(rows: DataFrame, path: str, stream: str, batch: int, fmt: str = "parquet") -> None:
    marked = rows.withColumns({"stream": F.lit(stream), "batch": F.lit(batch).cast("bigint")})
    writer = marked.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("stream", "batch").save(path)


def keep_late(root: str, keys: Sequence[str], event_time: str, delay: str) -> Write:
    """Replay removal that sets late rows aside, where ``drop_replays`` would discard them.

    Three tables below ``root``, each by ``stream`` and ``batch``: ``kept`` has the first row
    of each key (of several in one batch, the greatest), ``late`` every row that came later
    than ``delay`` after the newest event time of the batches before, and ``batches`` one
    line per batch. There, kept + late + replayed = records.

    A key is remembered for ``delay`` beyond the watermark, like Spark's own state. The
    memory is the ``kept`` table: only batches with a row that recent are read, found in
    ``batches``. A row without a time is never late; null keys are equal to each other.
    Lateness depends on earlier batches alone, so a repeated batch gives the same tables.
    """

    def write(rows: DataFrame, stream: str, batch: int) -> None:
        spark = rows.sparkSession
        earlier = _earlier(spark, root, stream, batch)
        newest = earlier.agg(F.max("newest")).scalar()
        watermark = F.timestamp_micros(newest) - F.expr(f"INTERVAL '{delay}'")
        remembered_from = watermark - F.expr(f"INTERVAL '{delay}'")

        rows = rows.persist()
        try:
            at = F.col(event_time).cast("timestamp")
            is_late = F.coalesce(at < watermark, F.lit(False))
            records, late, latest = rows.agg(
                F.count(F.lit(1)), F.count_if(is_late), F.unix_micros(F.max(at))
            ).first()
            _replace(rows.filter(is_late), f"{root}/late", stream, batch)

            fresh = keep_greatest(rows.filter(~is_late), keys)
            recent = earlier.filter((F.col("kept") > 0) & (F.timestamp_micros("newest") >= remembered_from))
            numbers = [line.batch for line in recent.select("batch").collect()]
            if numbers:
                folders = [f"{root}/kept/stream={stream}/batch={n}" for n in numbers]
                known = spark.read.schema(rows.schema).parquet(*folders)
                still = F.col(event_time).cast("timestamp")
                known = known.filter(still.isNull() | (still >= remembered_from))
                known = known.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
                same = [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys]
                fresh = fresh.join(known, same, "left_anti")
            _replace(fresh, f"{root}/kept", stream, batch)
        finally:
            rows.unpersist()

        here = f"{root}/kept/stream={stream}/batch={batch}"
        kept = safe_read_table(spark, here, rows.schema).count()
        line = [(records, kept, late, records - late - kept, latest, stream, batch)]
        _replace(spark.createDataFrame(line, LEDGER_SCHEMA).coalesce(1), f"{root}/batches", stream, batch)

    return write


def _earlier(spark: SparkSession, root: str, stream: str, batch: int) -> DataFrame:
    """The lines of the batches before this one."""
    lines = safe_read_table(spark, f"{root}/batches", LEDGER_SCHEMA)
    return lines.filter((F.col("stream") == stream) & (F.col("batch") < batch))


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """What a stateful stream remembers: one row per key, with the partition that holds it."""
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    return state.select("partition_id", "key.*")
