"""Shortest-pack-first packing of token pieces into sequences of a fixed length.

Only the histogram of piece lengths, at most ``size`` numbers, goes to the driver. Lengths
are placed longest first, each into the pattern of lengths with the most room left, and
pattern counts are updated; then every piece finds its sequence by its rank among the
pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.common import map_slices
from starledger.llm.tokens import SLICE_BYTES, bound_batches, encoder
from starledger.session import stage

SIZE = 2048
#: Id that ends each document.
END = 1
#: Ranks are counted within so many hash buckets of each length, so that a length that a
#: third of all pieces has is numbered by many tasks.
BUCKETS = 256


def token_pieces(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, end: int = END
) -> DataFrame:
    """Documents as ids with ``end`` behind, cut into pieces of ``size`` and a rest.

    (doc_id, start, length, ids_crc32, doc_tokens) per piece. Null texts are empty and
    give the end id alone. Repeated rows give repeated pieces.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ends, ids = encoder(path).encode(batch.column("text"))
        at, start, length, crc, total = [], [], [], [], []
        first = 0
        for i, last in enumerate(ends.tolist()):
            own = np.append(ids[first:last], np.uint32(end)).astype("<u4")
            first = last
            for k in range(0, len(own), size):
                part = own[k : k + size]
                at.append(i)
                start.append(k)
                length.append(len(part))
                crc.append(zlib.crc32(part))
                total.append(len(own))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(at, pa.int32())), *[pa.array(x, pa.int64()) for x in (start, length, crc, total)]],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
        )

    return map_slices(
        rows, run, f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint", limit=SLICE_BYTES
    )


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths) of packs that hold every piece of the histogram.

    Each step uses up a length or a kind of pack, so there are at most twice as many kinds
    as lengths.
    """
    room: dict[int, list] = defaultdict(list)  # free places -> kinds of pack
    most: list[int] = []  # free places of all kinds, the most first

    def put(free: int, count: int, lengths: tuple[int, ...]) -> None:
        room[free].append((count, lengths))
        heappush(most, -free)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not most or -most[0] < length:
                fits = size // length
                # As many as fit together at once where no pack has room: then none of this
                # length is left to open the next.
                whole, rest = divmod(left, fits)
                if whole:
                    put(size - fits * length, whole, (length,) * fits)
                if rest:
                    put(size - rest * length, 1, (length,) * rest)
                break
            free = -heappop(most)
            count, lengths = room[free].pop()
            used = min(count, left)
            put(free - length, used, (*lengths, length))
            if count > used:
                put(free, count - used, lengths)
            left -= used
    return [kind for kinds in room.values() for kind in kinds]


def slots(kinds: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first, last, fold, sequence, offset): pieces of ``length`` with ranks from
    ``first`` to ``last`` lie ``fold`` to a sequence, from ``sequence`` on, at ``offset``."""
    rows, taken, sequence = [], defaultdict(int), 0
    for count, lengths in kinds:
        offset = 0
        for length in dict.fromkeys(lengths):
            fold = lengths.count(length)
            first = taken[length]
            taken[length] += count * fold
            rows.append((length, first, taken[length] - 1, fold, sequence, offset))
            offset += fold * length
        sequence += count
    return rows


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (doc_id, start, length, ...).

    Every piece lies in one sequence, at an offset that leaves no gap. Equal rows may
    change places with each other, with no trace. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    pieces = stage(pieces, "pieces")
    bucketed = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(BUCKETS)).cast("int"))
    counts = stage(bucketed.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    rows = slots(patterns(histogram, size))
    where = spark.createDataFrame(rows, "length long, _first long, _last long, _fold long, _sequence long, _offset long")
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", "ids_crc32")
    # Both lookups are bounded by the sequence length alone: size x BUCKETS counts, and slots
    # of at most 2 x size kinds of pack.
    ranked = bucketed.withColumn("_rank", F.row_number().over(within) - 1).join(F.broadcast(starts), ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_before", "_bucket")
    by_length = where.groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("_first", "_last", "_fold", "_sequence", "_offset"))).alias("_slots")
    )
    found = ranked.join(F.broadcast(by_length), "length")
    found = found.withColumn("_slot", _slot_of(F.col("_slots"), F.col("_rank")))
    place = F.col("_rank") - F.col("_slot._first")
    return found.select(
        *pieces.columns,
        (F.col("_slot._sequence") + F.floor(place / F.col("_slot._fold"))).cast("long").alias("sequence_id"),
        (F.col("_slot._offset") + place % F.col("_slot._fold") * F.col("length")).cast("long").alias("offset"),
    )


def _slot_of(slots_: F.Column, rank: F.Column) -> F.Column:
    """The slot whose ranks hold ``rank``: the last whose first rank is not above it."""
    return F.element_at(F.filter(slots_, lambda s: s._first <= rank), -1)


def pack_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    return pack(token_pieces(docs, path, doc_id, text, size), size)
