"""Exact top-k search by distributed histogram selection.

Vectors become whole numbers, so scores are exact. Every row is scored against every query,
and per query a histogram of the scores is summed over all tasks; the bin that holds the kth
highest score is cut into a finer histogram, until that bin holds few scores or one value.
What reaches it is then filtered out and ranked, ties by the smaller id.

Queries are taken in blocks of bounded size, each sent to the tasks that hold the rows. A
task keeps one small histogram per query of a block. Of it, it returns only the highest bins
that hold its own first k scores: the kth score of all rows is never below the kth of some.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starledger.llm.vectors import Shape, measure, usable_rows, whole
from starledger.operators.numbering import number_rows
from starledger.session import fresh_path, stage

#: Rows in a tile, and bytes of doubles in it at most; queries scored against a tile at once.
TILE, TILE_BYTES, SLAB = 4096, 8 << 20, 256
#: Queries in a block, and bytes of doubles in it at most: what is sent to every task.
BLOCK, BLOCK_BYTES = 8192, 64 << 20
BINS = 256
#: A histogram is refined no further where so many times k scores are left.
FEW = 4
#: Scores outside this range are given as its end.
LIMIT = (1 << 62) - 1
_LAST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Block:
    """Queries of one block: per length of vector the places of its queries and their vectors;
    the tile and place that each comes from; and the histogram that is to be counted."""

    vectors: dict[int, tuple[np.ndarray, np.ndarray]]
    tile: np.ndarray
    place: np.ndarray
    ids: np.ndarray
    number: np.ndarray
    bound: int
    low: np.ndarray
    width: np.ndarray
    open: np.ndarray


def products(q: np.ndarray, x: np.ndarray, bound: int) -> np.ndarray:
    """Exact inner products of rows; ``bound`` limits the sum of absolute terms."""
    if bound < 1 << 24:
        return q.astype(np.float32) @ x.astype(np.float32).T
    if bound < 1 << 53:
        return q.astype(np.float64) @ x.astype(np.float64).T
    exact = [np.array([[int(v) for v in row] for row in m.tolist()], object).reshape(m.shape) for m in (q, x)]
    return np.clip(exact[0] @ exact[1].T, -LIMIT, LIMIT).astype(np.int64)


def _tiles(rows: DataFrame, scale: int, shape: Shape) -> DataFrame:
    """(tile, dim, ids, data): neighbouring rows of one length, packed."""
    kind = shape.kind

    def run(batches):
        tile = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column("vec_id")
            for at, x in whole(batch.column("vector"), scale):
                size = max(1, min(TILE, TILE_BYTES // (8 * x.shape[1])))
                for i in range(0, len(at), size):
                    own = ids.take(pa.array(at[i : i + size])).to_pylist()
                    data = x[i : i + size].astype(kind).tobytes()
                    yield pa.RecordBatch.from_pydict(
                        {"tile": pa.array([tile], pa.int64()), "dim": pa.array([x.shape[1]], pa.int32()), "ids": pa.array([own], pa.list_(pa.int64())), "data": pa.array([data], pa.binary())}
                    )
                    tile += 1

    return rows.mapInArrow(run, "tile bigint, dim int, ids array<bigint>, data binary")


def _unpacked(batch: pa.RecordBatch, kind: np.dtype):
    """(tile, ids with null as the last number, vectors) of each tile."""
    for k in range(batch.num_rows):
        ids = batch.column("ids")[k].values.fill_null(int(_LAST)).to_numpy()
        data = np.frombuffer(batch.column("data")[k].as_buffer(), kind).reshape(len(ids), -1)
        yield batch.column("tile")[k].as_py(), ids, data


def _queries(tiles: DataFrame, every: int, kind: np.dtype) -> DataFrame:
    """(tile, place, dim, vec_id, data) of the rows whose id is divisible by ``every``."""

    def run(batches):
        for batch in batches:
            for tile, ids, x in _unpacked(batch, kind):
                at = np.flatnonzero((ids % every == 0) & (ids != _LAST))
                n = len(at)
                yield pa.RecordBatch.from_pydict(
                    {"tile": pa.array([tile] * n, pa.int64()), "place": pa.array(at, pa.int64()), "dim": pa.array([x.shape[1]] * n, pa.int32()), "vec_id": pa.array(ids[at]), "data": pa.array([x[i].tobytes() for i in at], pa.binary())}
                )

    return tiles.mapInArrow(run, "tile bigint, place bigint, dim int, vec_id bigint, data binary")


def _block(queries: DataFrame, first: int, size: int, shape: Shape) -> Block:
    rows = queries.filter(F.col("number").between(first, first + size - 1)).collect()
    dims = np.array([r.dim for r in rows], int)
    vectors = {}
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        vectors[dim] = (at, np.frombuffer(b"".join(bytes(rows[i].data) for i in at), shape.kind).reshape(len(at), dim))
    longs = lambda name: np.array([r[name] for r in rows], np.int64)
    bound = shape.bound**2 * int(dims.max())
    most = min(bound, LIMIT)
    n = len(rows)
    width = np.full(n, -(-(2 * most + 1) // BINS), np.int64)
    return Block(vectors, longs("tile"), longs("place"), longs("vec_id"), longs("number"), bound, np.full(n, -most, np.int64), width, np.ones(n, bool))


def _scored(batches, block: Block, kind: np.dtype, wanted: np.ndarray):
    """(queries, ids, scores) of every tile against every slab of the wanted queries; the
    query's own row has no score, which is given as nan or as the least number."""
    for batch in batches:
        for tile, ids, x in _unpacked(batch, kind):
            at, q = block.vectors.get(x.shape[1], (np.empty(0, int), None))
            chosen = np.flatnonzero(wanted[at])
            for i in range(0, len(chosen), SLAB):
                part = chosen[i : i + SLAB]
                s = products(q[part], x, block.bound)
                own = np.flatnonzero(block.tile[at[part]] == tile)
                s[own, block.place[at[part[own]]]] = np.nan if s.dtype.kind == "f" else -LIMIT - 1
                yield at[part], ids, s


def _histograms(tiles: DataFrame, shared, kind: np.dtype, k: int) -> DataFrame:
    """(query, bin, n): scores per bin of each open query, summed over all rows; bin ``BINS``
    holds what lies above the histogram."""

    def run(batches):
        block: Block = shared.value
        counts = np.zeros((len(block.low), BINS + 1), np.int64)
        floor = block.low.copy()
        for at, _, s in _scored(batches, block, kind, block.open):
            i, j = np.nonzero(s >= floor[at].astype(s.dtype)[:, None])
            own = at[i]
            bins = np.minimum((s[i, j].astype(np.int64) - block.low[own]) // block.width[own], BINS)
            mine = counts[at] + np.bincount(i * (BINS + 1) + bins, minlength=len(at) * (BINS + 1)).reshape(len(at), -1)
            counts[at] = mine
            above = np.cumsum(mine[:, ::-1], axis=1) >= k
            held = BINS - above.argmax(axis=1)
            full = above.any(axis=1)
            floor[at[full]] = (block.low[at] + held * block.width[at])[full]
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts  # scores in higher bins
        query, bins = np.nonzero((counts > 0) & (above < k))
        yield pa.RecordBatch.from_pydict({"query": pa.array(query, pa.int64()), "bin": pa.array(bins, pa.int64()), "n": pa.array(counts[query, bins])})

    return tiles.mapInArrow(run, "query bigint, bin bigint, n bigint").groupBy("query", "bin").agg(F.sum("n").alias("n"))


def _refined(block: Block, tiles: DataFrame, kind: np.dtype, k: int) -> Block:
    """Count one histogram, and narrow each query's range to the bin of its kth score."""
    shared = tiles.sparkSession.sparkContext.broadcast(block)
    from_top = Window.partitionBy("query").orderBy(F.desc("bin"))
    upto = _histograms(tiles, shared, kind, k).withColumn("upto", F.sum("n").over(from_top))
    # The highest bin that takes the count to k; one row per query of the block.
    found = upto.filter(F.col("upto") >= k).groupBy("query").agg(F.max("bin").alias("bin"), F.min("upto").alias("upto")).collect()
    shared.destroy()
    low, width, left = block.low.copy(), block.width.copy(), np.zeros(len(block.low), bool)
    for query, bin_, upto in found:  # queries not found have fewer than k scores, and keep all
        low[query] += bin_ * width[query]
        left[query] = upto > FEW * k and width[query] > 1
        width[query] = -(-width[query] // BINS)
    return replace(block, low=low, width=width, open=block.open & left)


def _best(number, ids, scores, k: int) -> np.ndarray:
    """Places of each query's first ``k``: highest score first, then smaller id."""
    order = np.lexsort((ids, -scores, number))
    number = number[order]
    first = np.concatenate(([True], number[1:] != number[:-1])) if len(number) else np.empty(0, bool)
    begin = np.flatnonzero(first)
    rank = np.arange(len(number)) - np.repeat(begin, np.diff(np.append(begin, len(number))))
    return order[rank < k]


def _picked(tiles: DataFrame, shared, kind: np.dtype, k: int) -> DataFrame:
    """(number, query_id, vec_id, score): each task's own first ``k`` of what reaches a
    query's threshold."""

    def run(batches):
        block: Block = shared.value
        held = [np.empty(0, np.int64)] * 3
        more, size = [], 0
        everything = np.ones(len(block.low), bool)

        def folded():
            query, ids, scores = (np.concatenate(x) for x in zip(held, *more))
            keep = _best(query, ids, scores, k)
            return [query[keep], ids[keep], scores[keep]]

        for at, ids, s in _scored(batches, block, kind, everything):
            i, j = np.nonzero(s >= block.low[at].astype(s.dtype)[:, None])
            more.append((at[i], ids[j], s[i, j].astype(np.int64)))
            size += len(i)
            if size > 1 << 20:
                held, more, size = folded(), [], 0
        query, ids, scores = folded()
        yield pa.RecordBatch.from_pydict(
            {
                "number": pa.array(block.number[query]),
                "query_id": pa.array(block.ids[query]),
                "vec_id": pa.array(ids, mask=ids == _LAST),
                "score": pa.array(scores),
            }
        )

    return tiles.mapInArrow(run, "number bigint, query_id bigint, vec_id bigint, score bigint")


def top_k(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 5, every: int = 50, scale: int = 256, block: int = BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of highest score for each query.

    A component x becomes floor(scale * x); the score is the inner product of two vectors of
    one length. Queries are the rows whose id is divisible by ``every``; candidates are all
    rows but the query's own. With fewer candidates than ``k`` all are returned. Ties go to
    the smaller id, null ids last.

    Vectors that are null, have no component, or hold null or non-finite ones take no part.
    A null id is no query. Rows with equal ids are queries and candidates each for itself. A
    score beyond 2^62 is given as that. An empty table gives an empty result; no other column
    is read.
    """
    spark = vectors.sparkSession
    rows = usable_rows(vectors, vec_id=vec_id, vector=vector).withColumn("vec_id", F.col("vec_id").cast("bigint"))
    shape = measure(rows, scale)
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not shape.rows:
        return spark.createDataFrame([], schema)
    tiles = stage(_tiles(rows, scale, shape), "search-tiles")
    queries = stage(number_rows(_queries(tiles, every, shape.kind), label="search-placed"), "search-queries")
    out = fresh_path(spark, "search-hits")
    size = max(1, min(block, BLOCK_BYTES // (8 * shape.most)))
    total = queries.count()
    if not total:
        return spark.createDataFrame([], schema)
    ranked = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    for number, first in enumerate(range(0, total, size)):
        own = _block(queries, first, size, shape)
        while own.open.any():
            own = _refined(own, tiles, shape.kind, k)
        shared = spark.sparkContext.broadcast(own)
        hits = _picked(tiles, shared, shape.kind, k).withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
        hits.select("query_id", "rank", "vec_id", "score").write.mode("overwrite").parquet(f"{out}/block={number}")
        shared.destroy()
    return spark.read.schema(f"{schema}, block int").parquet(out).drop("block")
