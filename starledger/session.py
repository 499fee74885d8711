"""Session settings, and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


#: What one task reads, from files and, with adaptive plans, from a shuffle: its memory follows
#: from these, whatever the size of the tables. Large tables are staged in row groups small
#: enough for that. Shuffles are dealt finely and their parts joined up to the size.
TASK_BYTES, GROUP_BYTES, SHUFFLE_PARTS = 16 << 20, 4 << 20, 400
#: Paths staged by the innermost ``temporary_tables`` of this thread.
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def build_session(app_name: str = "starledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps, adaptive plans and a disk-backed stream state.

    Cluster sizing (executors, memory, shuffle partitions) is left to the submitter.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return bound_tasks(pin(builder.getOrCreate()))


def pin(spark: SparkSession) -> SparkSession:
    """Fix the one setting that changes results: the time zone of date parts."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def bound_tasks(spark: SparkSession) -> SparkSession:
    """Bound what one task reads, in settings that the submitter has left alone."""
    parts = max(SHUFFLE_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for key, value in {
        "spark.sql.files.maxPartitionBytes": TASK_BYTES,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": parts,
    }.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, str(value))
    return spark


def workspace(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session that
    names none gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    # "local-cluster[...]" has executors in processes of their own.
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="starledger-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the workspace that nothing has used yet."""
    return f"{workspace(spark)}/{label}-{uuid.uuid4().hex}"


def temporary_path(spark: SparkSession, label: str) -> str:
    """A fresh path that ``temporary_tables`` removes, if one is open in this thread."""
    path = fresh_path(spark, label)
    listed = _STAGED.get()
    if listed is not None:
        listed.append(path)
    return path


def stage(df: DataFrame, label: str, group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` once to the workspace and read it back.

    Used where several jobs need the same rows: it cuts the lineage, survives the
    loss of executors, and gives the planner real file sizes. ``group_bytes`` sets the
    size of row groups, beneath which no file is cut among tasks.
    """
    spark = df.sparkSession
    path = temporary_path(spark, label)
    writer = df.write if group_bytes is None else df.write.option("parquet.block.size", group_bytes)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Remove what ``stage`` writes within the block, in this thread, once the block has ended,
    and what lies at its ``temporary_path``s.

    Nothing made in the block that still reads a staged table can be used afterwards. After
    an error the tables stay, as do those staged outside of any block.
    """
    paths: list[str] = []
    token = _STAGED.set(paths)
    try:
        yield
    finally:
        _STAGED.reset(token)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = hadoop(path)
        place.getFileSystem(conf).delete(place, True)
