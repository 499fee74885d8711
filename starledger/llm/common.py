"""Helpers shared by the operators: tables, id filters, byte-bounded slices of Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a maximal run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that a task works on at once.
SLICE_BYTES = 1 << 20
#: Ids that may be broadcast: 2 million longs are some 32 MB. Beyond, the join shuffles.
BROADCAST_IDS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text) -> F.Column:
    """The words of a text column as an array; none for null. Splitting at single blanks,
    which Java does without a regular expression, costs less than matching ``WORD``."""
    for space in "\t\n\x0b\f\r":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.coalesce(F.array_remove(F.split(text, " "), ""), F.array().cast("array<string>"))


def held_out(doc_id) -> F.Column:
    """True for the fifth of ids that labels are never learnt from: crc32(id as text) mod 5 = 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def is_small(ids: DataFrame, limit: int = BROADCAST_IDS) -> bool:
    """Whether a table of ids (staged, so cheap to count) may be broadcast."""
    return ids.count() <= limit


def having_ids(df: DataFrame, ids: DataFrame, key: str, small: bool) -> DataFrame:
    """Rows of ``df`` whose key is in ``ids`` (distinct): by broadcast when small, else by shuffle."""
    return df.join(F.broadcast(ids) if small else ids, key, "left_semi")


def lacking_ids(df: DataFrame, ids: DataFrame, key: str, small: bool) -> DataFrame:
    """Rows of ``df`` whose key is not in ``ids``, null keys included."""
    return df.join(F.broadcast(ids) if small else ids, key, "left_anti")


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text of an Arrow column; null gives b''."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about ``limit`` bytes of text each, one row at least."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    first = size = 0
    for i, n in enumerate(lengths):
        if i > first and size + n > limit:
            yield batch.slice(first, i - first)
            first, size = i, 0
        size += n
    if first < batch.num_rows:
        yield batch.slice(first)


def release() -> None:
    """Give the memory that this process has freed back to the system, where the C library can.

    Workers wait for further tasks and keep what they once took, beside the executor's heap.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_slices(df: DataFrame, function, schema: str, text: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` that hands ``function`` slices of bounded size; it returns a RecordBatch.

    At its end a task gives back what it has freed."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, text, limit):
                yield function(part)
        batch = part = None
        release()

    return df.mapInArrow(run, schema)
