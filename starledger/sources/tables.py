"""Tables addressed by path. The format is a parameter; none is imported."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starledger.schemas import ITEM_SCHEMA, from_wire, wire_schema
from starledger.session import stage

# The error conditions of Spark and of Delta for a path without a table.
_NOTHING_THERE = {
    "PATH_NOT_FOUND",
    "UNABLE_TO_INFER_SCHEMA",
    "DELTA_TABLE_NOT_FOUND",
    "DELTA_PATH_DOES_NOT_EXIST",
    "DELTA_MISSING_DELTA_TABLE",
}


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """A table by path, in plain column names whichever names it was written with."""
    reader = spark.read.format(fmt)
    return from_wire((reader.schema(schema) if schema is not None else reader).load(path))


def safe_read_table(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet"
) -> DataFrame:
    """Like ``read_table``, but a missing or empty folder is an empty table."""
    try:
        return read_table(spark, path, fmt)
    except AnalysisException as error:
        if error.getCondition() in _NOTHING_THERE:
            return spark.createDataFrame([], schema)
        raise


def read_items_csv(spark: SparkSession, path: str) -> DataFrame:
    """The item file: a header row, then id, title and ``A|B|C`` tags.

    Columns are found by their names in the header, in any order and among others; a
    missing one is an error. Values are cast, so an id that is not a number reads as null
    and is dropped by cleaning.
    """
    raw = _csv_reader(spark).csv(path)
    wanted = _wanted(raw, path)
    return from_wire(raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted]))


def read_items_and_rejects(spark: SparkSession, path: str, multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """The item file as (items, rejects): each record is in one of them.

    A record is rejected as ``unreadable`` when it has too few or too many fields or a value
    of another type, and as ``incomplete`` when it lacks an id or title. Rejects carry the
    reason and the record: its text as it stands in the file, or, where that could be read, its fields as CSV.

    With ``multiline``, quoted values may contain line breaks. A quote that is never closed
    then takes the lines after it into one rejected record, where otherwise it ends with
    its line, and a file is read by one task.
    """
    reader = _csv_reader(spark).option("multiLine", multiline)
    header = reader.csv(path)
    types = {f.name: f.dataType for f in _wanted(header, path)}
    fields = [T.StructField(name, types.get(name, T.StringType())) for name in header.columns]
    schema = T.StructType([*fields, T.StructField(_TORN, T.StringType())])
    # Every column is parsed: with fewer, a record that lacks fields would not be noticed.
    reader = reader.schema(schema).option("columnNameOfCorruptRecord", _TORN).option("columnPruning", False)
    read = stage(reader.csv(path), "items-csv")

    torn, names = F.col(_TORN).isNotNull(), list(types)
    incomplete = F.col(names[0]).isNull() | F.col(names[1]).isNull()
    items = from_wire(read.filter(~torn & ~incomplete).select(*names))
    rejects = read.filter(torn | incomplete).select(
        F.when(torn, "unreadable").otherwise("incomplete").alias("reason"),
        F.coalesce(_TORN, F.to_csv(F.struct(*header.columns))).alias("record"),
    )
    return items, rejects


_TORN = "_corrupt_record"


def _csv_reader(spark: SparkSession) -> DataFrameReader:
    return spark.read.option("header", True).option("escape", '"')


def _wanted(raw: DataFrame, path: str) -> T.StructType:
    wanted = wire_schema(ITEM_SCHEMA)
    missing = [f.name for f in wanted if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header names {', '.join(raw.columns)}")
    return wanted


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    replace_schema: bool = False,
) -> None:
    """Write a table; overwrite by default.

    A Parquet overwrite always replaces the schema. ``replace_schema`` asks formats
    that keep a schema of their own to do the same.
    """
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace_schema:
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)


def is_empty(df: DataFrame) -> bool:
    """Whether a view has nothing to show; reads at most one row."""
    return df.isEmpty()
