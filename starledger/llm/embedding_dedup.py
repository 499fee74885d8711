"""Embedding near-duplicates: exact cosine links from int8 tile products.

Unit vectors are quantised to int8 with one scale each. The quantisation error of a vector
is measured, so the true cosine of a pair lies within a proven distance of its int8
product: with x = s q + e, |x.y - s t q.r| <= |e| + |f| + |e||f| for unit x and y. A pair
whose lower bound reaches the threshold is a link, one whose upper bound does not is none;
only pairs between are computed again in double precision.

Tiles of one label meet pairwise, each pair of tiles as a task of its own, and only codes,
scales and errors travel to it. It returns for each vector how many links it has there and
the least vector it is connected with, never the pairs. Vectors with undecided pairs follow
in full to the pair of tiles that asks for them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.graph import components
from starledger.operators.joins import salted_join
from starledger.operators.numbering import number_rows
from starledger.session import stage

#: Vectors in a tile: a product of two tiles takes 4 MB in single precision.
TILE = 1024
#: What rounding in double precision may add to a bound.
ROUNDING = 1e-9


def _usable(vector: F.Column) -> F.Column:
    """No null or non-finite component, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no square may overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scale, error norm) of unit rows."""
    scale = np.abs(x).max(axis=1, keepdims=True) / 127.0
    codes = np.rint(x / scale).astype(np.int8)
    error = np.sqrt(((x - codes * scale) ** 2).sum(axis=1))
    return codes, scale[:, 0], error


def decided(x: tuple, y: tuple, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(sure links, undecided pairs) of two tiles (codes, scale, error), as matrices."""
    (qx, sx, ex), (qy, sy, ey) = x, y
    # Sums of products of int8 are whole numbers; up to 1000 terms single precision holds
    # them exactly, beyond that doubles do.
    kind = np.float32 if qx.shape[1] <= 1000 else np.float64
    near = (qx.astype(kind) @ qy.astype(kind).T).astype(np.float64) * sx[:, None] * sy[None, :]
    bound = ex[:, None] + ey[None, :] + ex[:, None] * ey[None, :] + ROUNDING
    sure = near - bound >= threshold
    return sure, ~sure & (near + bound >= threshold)


def least_connected(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row and column of a matrix of links the least id reachable by links in it."""
    far = np.iinfo(np.int64).max
    while True:
        more_left = np.minimum(left, np.where(links, right[None, :], far).min(axis=1, initial=far))
        more_right = np.minimum(right, np.where(links, more_left[:, None], far).min(axis=0, initial=far))
        if (more_left == left).all() and (more_right == right).all():
            return left, right
        left, right = more_left, more_right


def _found(links: np.ndarray, ids: tuple, copies: tuple) -> pa.RecordBatch:
    """(id, root, more) of the vectors of two tiles that have a link in the matrix."""
    rows, columns = np.flatnonzero(links.any(axis=1)), np.flatnonzero(links.any(axis=0))
    own = links[np.ix_(rows, columns)]
    left, right = ids[0][rows], ids[1][columns]
    roots = least_connected(own, left, right)
    more = own @ copies[1][columns], copies[0][rows] @ own
    return pa.RecordBatch.from_pydict(
        {"id": pa.array(np.concatenate((left, right))), "root": pa.array(np.concatenate(roots)), "more": pa.array(np.concatenate(more).astype(np.int64))}
    )


_FOUND = "id bigint, root bigint, more bigint"


def _codes(heads: DataFrame) -> DataFrame:
    """Unit vectors as int8: (id, label, dim, tile, copies, code, scale, error)."""
    label = heads.schema["label"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                x = unit_rows(part.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim))
                codes, scale, error = quantised(x)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in ("id", "label", "dim", "tile", "copies")], pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale), pa.array(error)],
                    names=["id", "label", "dim", "tile", "copies", "code", "scale", "error"],
                )

    return heads.mapInArrow(run, f"id bigint, label {label}, dim int, tile int, copies bigint, code binary, scale double, error double")


def _tile_pairs(tiles: DataFrame, columns: list[str]) -> DataFrame:
    """Every two tiles of one label and length, and each with itself."""
    last = tiles.groupBy("label", "dim").agg(F.max("tile").alias("last"))
    placed = tiles.join(last, ["label", "dim"])
    left = placed.withColumn("other", F.explode(F.sequence("tile", "last"))).drop("last")
    right = placed.withColumn("mine", F.explode(F.sequence(F.lit(0), "tile")))
    met = left.alias("l").join(right.alias("r"), F.expr("l.label = r.label AND l.dim = r.dim AND l.tile = r.mine AND l.other = r.tile"))
    both = [F.col(f"{side}.{c}").alias(f"{c}_{side}") for side in ("l", "r") for c in columns]
    return met.select(F.col("l.label").alias("label"), F.col("l.dim").alias("dim"), F.col("l.tile").alias("i"), F.col("r.tile").alias("j"), *both)


def _arrays(batch: pa.RecordBatch, k: int, side: str, dim: int):
    """(ids, copies, (codes, scale, error)) of one tile of a pair."""
    get = lambda c: batch.column(f"{c}_{side}")[k].values
    codes = np.frombuffer(b"".join(get("code").to_pylist()), np.int8).reshape(-1, dim)
    return get("ids").to_numpy(), get("copies").to_numpy(), (codes, get("scale").to_numpy(), get("error").to_numpy())


def _compared(pairs: DataFrame, threshold: float) -> DataFrame:
    """Per pair of tiles the sure links' (id, root, more), and for undecided pairs rows with
    ``i`` and ``j`` set and no root."""
    label = pairs.schema["label"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                dim, i, j = (batch.column(c)[k].as_py() for c in ("dim", "i", "j"))
                ids_x, copies_x, x = _arrays(batch, k, "l", dim)
                ids_y, copies_y, y = _arrays(batch, k, "r", dim)
                sure, open_ = decided(x, y, threshold)
                if i == j:  # each pair once, none with itself
                    sure, open_ = np.triu(sure, 1), np.triu(open_, 1)
                found = _found(sure, (ids_x, ids_y), (copies_x, copies_y))
                ask = np.unique(np.concatenate((ids_x[open_.any(axis=1)], ids_y[open_.any(axis=0)])))
                n, m = found.num_rows, len(ask)
                own = lambda v, kind: pa.concat_arrays([pa.nulls(n, kind), pa.array([v] * m, kind)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([found.column("id"), pa.array(ask, pa.int64())]),
                        pa.concat_arrays([found.column("root"), pa.nulls(m, pa.int64())]),
                        pa.concat_arrays([found.column("more"), pa.nulls(m, pa.int64())]),
                        own(batch.column("label")[k].as_py(), batch.schema.field("label").type),
                        own(dim, pa.int32()), own(i, pa.int32()), own(j, pa.int32()),
                    ],
                    names=["id", "root", "more", "label", "dim", "i", "j"],
                )

    return pairs.mapInArrow(run, f"{_FOUND}, label {label}, dim int, i int, j int")


def _recomputed(asked: DataFrame, heads: DataFrame, threshold: float) -> DataFrame:
    """(id, root, more) of undecided pairs that are links in double precision."""
    vectors = heads.select("id", "vector", "tile", "copies")
    full = asked.select("id", "label", "dim", "i", "j").join(vectors, "id")

    def run(table: pa.Table) -> pa.Table:
        tile, i, j = (table.column(c).to_numpy() for c in ("tile", "i", "j"))
        ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
        x = unit_rows(table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1))
        # In the order of their ids, so that a pair within one tile is taken once.
        order = np.argsort(ids)
        left, right = order[(tile == i)[order]], order[(tile == j)[order]]
        code = quantised(x)
        part = lambda at: tuple(c[at] for c in code)
        _, open_ = decided(part(left), part(right), threshold)
        if len(i) and i[0] == j[0]:
            open_ = np.triu(open_, 1)
        a, b = np.nonzero(open_)
        links = np.zeros_like(open_)
        for k in range(0, len(a), 1 << 16):
            p, q = a[k : k + (1 << 16)], b[k : k + (1 << 16)]
            links[p, q] = np.einsum("ij,ij->i", x[left[p]], x[right[q]]) >= threshold
        return pa.Table.from_batches([_found(links, (ids[left], ids[right]), (copies[left], copies[right]))])

    return full.groupBy("label", "dim", "i", "j").applyInArrow(run, _FOUND)


def embedding_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93, tile: int = TILE
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors``.

    Vectors of one label, of any type, and one length are linked when their cosine, in
    doubles, is ``threshold`` or more. Equal vectors are compared once and counted as often
    as they occur. Vectors that are null, all zero, or hold nulls or non-finite numbers, and
    those with a null label or id, are linked with nothing. Each row counts as a vector; rows
    with one id are one node, whose least ``component_id`` all of them get. An empty table
    gives an empty result; no other column is read.
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    usable = _usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    # Equal vectors form a class, known by two hashes. Zeros of both signs hash alike.
    plain = F.transform("vector", lambda x: x + F.lit(0.0))
    pair = F.struct(F.xxhash64(plain, F.col("label")).alias("h1"), F.xxhash64(F.lit(7), F.col("label"), plain).alias("h2"))
    keyed = rows.withColumn("class", F.when(usable, pair))
    classes = keyed.filter("class IS NOT NULL").groupBy("class").agg(
        F.min(F.struct("vec_id", "vector")).alias("v"), F.any_value("label").alias("label"), F.count(F.lit(1)).alias("copies")
    )
    classes = stage(
        number_rows(classes, "id", "classes").select("id", "class", "label", "copies", F.col("v.vec_id").alias("head"), F.col("v.vector").alias("vector")),
        "classes-numbered",
    )
    heads = classes.select("id", "label", "copies", "vector", F.size("vector").alias("dim"))
    sizes = heads.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    sizes = stage(sizes, "label-sizes")
    # Most rows may have one label: without a broadcast they are dealt by slices of it.
    spread = heads.join(F.broadcast(sizes) if sizes.count() <= 100_000 else sizes, ["label", "dim"])
    heads = spread.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")).drop("tiles")
    packed = F.collect_list(F.struct("id", "copies", "code", "scale", "error")).alias("rows")
    tiles = _codes(heads).groupBy("label", "dim", "tile").agg(packed)
    tiles = stage(tiles.select("label", "dim", "tile", F.col("rows.id").alias("ids"), *[f"rows.{c}" for c in ("copies", "code", "scale", "error")]), "tiles")
    compared = stage(_compared(_tile_pairs(tiles, ["ids", "copies", "code", "scale", "error"]), threshold), "compared")
    asked = compared.filter("root IS NULL")
    found = compared.filter("root IS NOT NULL").select("id", "root", "more")
    found = stage(found.unionByName(_recomputed(asked, heads, threshold)), "links")

    # Components over classes: their links, and ids that are in several classes.
    member = salted_join(keyed.filter("class IS NOT NULL").select("vec_id", "class"), classes.select("class", "id"), "class", "inner", classes.select("class", F.col("copies").alias("n")))
    member = stage(member.select("vec_id", "id"), "members")
    shared = member.groupBy("vec_id").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most").select("vec_id", "least")
    through = member.join(stage(shared, "shared-ids"), "vec_id").select(F.col("id").alias("a"), F.col("least").alias("b"))
    edges = found.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(through)
    merged = stage(components(edges).select(F.col("node").alias("id"), "component"), "merged")
    degree = found.groupBy("id").agg(F.sum("more").alias("more"))
    each = classes.select("id", "class", "head", "copies").join(merged, "id", "left").join(degree, "id", "left")
    each = stage(each.withColumn("component", F.coalesce("component", "id")), "class-results")
    names = stage(each.groupBy("component").agg(F.min("head").alias("component_id"), F.count(F.lit(1)).alias("n")), "component-names")
    named = salted_join(each, names.drop("n"), "component", "inner", names.select("component", "n"))
    links = F.coalesce("more", F.lit(0)) + F.col("copies") - 1
    result = stage(named.select("class", links.cast("bigint").alias("n_links"), "component_id", F.col("copies").alias("n")), "class-links")
    linked = salted_join(keyed.filter("class IS NOT NULL").select("vec_id", "class"), result.drop("n"), "class", "inner", result.select("class", "n"))
    linked = linked.select("vec_id", "n_links", "component_id")
    # Rows that are linked with nothing may share the id of one that is.
    per_id = member.join(result.join(classes.select("class", "id"), "class").select("id", "component_id"), "id").groupBy("vec_id").agg(F.min("component_id").alias("component_id"))
    rest = keyed.filter("class IS NULL").select("vec_id").join(per_id, "vec_id", "left").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    out = linked.unionByName(rest)
    return out.withColumn("kept", F.col("component_id").eqNullSafe(F.col("vec_id")))
