"""Vector code compression: product codes by rounds of exact integer k-means, with LAESA.

Vectors become whole numbers and are cut into equal parts; each part position has a codebook
of a few entries. Some entries of the first codebook serve as pivots for good. The distance
of every part to its position's pivots is computed once and stored beside it. In a round only
entries are new: by the triangle inequality the difference of a part's and an entry's
distances to a pivot bounds their own distance from below. Entries are visited in the order
of these bounds and a part is done when the next bound exceeds what it has found, so most
entries are never evaluated; those that are, in whole numbers.

A round is one pass over the stored parts. Each task sums its parts per entry and returns
those sums alone, a few thousand numbers whatever the size of the table.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.llm.vectors import Shape, binary, matrix, measure, one_length, usable_rows, whole
from starledger.operators.joins import lookup_join
from starledger.session import stage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Pivots of a part position.
PIVOTS = 4
#: What a stored distance, in single precision, may be off by, as a share of it.
SLACK = 2.0**-21


@dataclass(frozen=True)
class Codebooks:
    """``entries``[part, entry, place]: whole numbers."""

    entries: np.ndarray

    def text(self) -> str:
        """All components in decimal by part, entry and place, joined by commas."""
        return ",".join(map(str, self.entries.ravel().tolist()))

    def sha256(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()


def _start(rows: DataFrame, scale: int, parts: int, entries: int) -> np.ndarray:
    """The first codebooks: the vectors of the least ids. Of rows with one id the vector that
    comes first in order counts. Each task returns as many as may be needed, no more."""

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            ids, known = batch.column("vec_id"), batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            for at, x in whole(batch.column("vector"), scale):
                wanted = known[at] if len(held) < entries else known[at] & (ids[at] <= max(held))
                chosen = np.flatnonzero(wanted)
                for i in chosen[np.argsort(ids[at[chosen]], kind="stable")].tolist():
                    own = int(ids[at[i]])
                    if len(held) >= entries and own > max(held):
                        break
                    vector = x[i].astype(np.int64).tolist()
                    held[own] = min(held.get(own, vector), vector)
                    if len(held) > entries:
                        del held[max(held)]
        yield pa.RecordBatch.from_pydict({"id": pa.array(list(held), pa.int64()), "x": pa.array(list(held.values()), pa.list_(pa.int64()))})

    least = rows.mapInArrow(run, "id bigint, x array<bigint>").groupBy("id").agg(F.min("x").alias("x"))
    found = [r.x for r in least.orderBy("id").limit(entries).collect()]
    if not found:
        return np.empty((parts, 0, 0), np.int64)
    return np.array(found, np.int64).reshape(len(found), parts, -1).transpose(1, 0, 2)


def pivots_of(entries: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Indices of ``n`` entries that lie far from each other: each next one is that whose least
    distance to those before is greatest, the first on ties."""
    x = entries.astype(np.float64)
    chosen = [0]
    least = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(x)):
        chosen.append(int(least.argmax()))
        least = np.minimum(least, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return np.array(chosen)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to pivots."""
    return np.sqrt(((x[:, None, :].astype(np.float64) - pivots[None].astype(np.float64)) ** 2).sum(axis=2))


def nearest(x: np.ndarray, near: np.ndarray, entries: np.ndarray, entry_near: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index of the nearest entry, squared distance, distances evaluated) of each row.

    ``near`` and ``entry_near`` are the distances of rows and entries to the pivots. Ties go
    to the lower index. ``x`` and ``entries`` are whole numbers in a type that holds their
    squared distances exactly.
    """
    n, m = len(x), len(entries)
    mine, theirs = near[:, None, :].astype(np.float64), entry_near[None]
    # Rounded down by more than both distances can be off by, so it stays a bound.
    bound = (np.abs(mine - theirs) - SLACK * (mine + theirs) - 1e-6).max(axis=2)
    bound = np.square(np.maximum(bound, 0)) * (1 - 1e-12)
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(n, np.inf if x.dtype.kind == "f" else np.iinfo(np.int64).max, x.dtype)
    code = np.full(n, m)
    live, work = np.arange(n), 0
    for step in range(m):
        entry = order[live, step]
        still = bound[live, entry] <= best[live]
        live, entry = live[still], entry[still]
        if not len(live):
            break
        work += len(live)
        d = np.square(x[live] - entries[entry]).sum(axis=1)
        better = (d < best[live]) | ((d == best[live]) & (entry < code[live]))
        best[live[better]] = d[better]
        code[live[better]] = entry[better]
    return code, best, work


@dataclass(frozen=True)
class _Coder:
    """Assigns the parts of stored rows to the entries of a codebook."""

    entries: np.ndarray
    pivots: np.ndarray
    stored: np.dtype
    exact: np.dtype

    def run(self, batch: pa.RecordBatch):
        """(parts x of all rows, codes, squared distances): rows in the first axis."""
        parts = len(self.entries)
        x = matrix(batch.column("x"), self.stored).reshape(batch.num_rows, parts, -1).astype(self.exact)
        near = matrix(batch.column("near"), np.dtype(np.float32)).reshape(batch.num_rows, parts, -1)
        codes, errors = np.empty((batch.num_rows, parts), np.int64), np.empty((batch.num_rows, parts), np.int64)
        for p in range(parts):
            own = self.entries[p].astype(self.exact)
            codes[:, p], errors[:, p], _ = nearest(x[:, p], near[:, p], own, distances(self.entries[p], self.pivots[p]))
        return x, codes, errors


def _sums(stored: DataFrame, coder: _Coder) -> DataFrame:
    """(part, entry, n, sums): per entry the number of its parts and their sums by place."""
    parts, m, width = coder.entries.shape

    def run(batches):
        n = np.zeros((parts, m), np.int64)
        sums = np.zeros((parts, m, width), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, codes, _ = coder.run(batch)
            for p in range(parts):
                n[p] += np.bincount(codes[:, p], minlength=m)
                order = np.argsort(codes[:, p], kind="stable")
                own = codes[order, p]
                first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                sums[p][own[first]] += np.add.reduceat(x[order, p].astype(np.int64), first, axis=0)
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()), "n": pa.array(n[p, e]), "sums": pa.array(list(sums[p, e]), pa.list_(pa.int64()))}
        )

    each = stored.mapInArrow(run, "part int, entry int, n bigint, sums array<bigint>")
    total = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    return each.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total).select("part", "entry", "n", F.array(*[f"s{i}" for i in range(width)]).alias("sums"))


def _round(stored: DataFrame, coder: _Coder) -> np.ndarray:
    """The next codebooks: floors of the entries' means; entries without parts stay."""
    new = coder.entries.copy()
    for r in _sums(stored, coder).collect():  # parts x entries rows
        new[r.part, r.entry] = [s // r.n for s in r.sums]
    return new


def _exact_kind(shape: Shape, width: int) -> np.dtype:
    """Doubles while they hold every squared distance exactly, else longs."""
    most = width * (2 * shape.bound) ** 2
    if most < 1 << 53:
        return np.dtype(np.float64)
    if most < 1 << 62:
        return np.dtype(np.int64)
    raise ValueError("components are too large for exact 64-bit distances")


def label_key(label) -> F.Column:
    """A label as text, null as a text that no label has."""
    return F.coalesce(F.concat(F.lit("="), label.cast("string")), F.lit("null"))


def compress(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, Codebooks]:
    """((vec_id, label, codes, error) per kept row, the final codebooks).

    A component x becomes floor(scale * x). Vectors are cut into ``parts`` equal parts; each
    part position's codebook starts as that part of the ``entries`` least kept ids. Each round
    assigns every part to its nearest entry by squared distance, ties to the lower index, and
    replaces entries by the floored means of their parts. ``codes`` are the indices of a last
    assignment, by part, and ``error`` is its squared distances summed over the parts.

    Vectors that are null, have no component, or hold null or non-finite ones are dropped.
    Fewer kept ids than ``entries`` make smaller codebooks; rows with a null id are coded but
    start no entry, unless no row has an id: then the result is empty. Rows with equal ids are
    coded each for itself. All kept vectors must have one length, a multiple of ``parts``, and
    no squared distance may exceed 2^62: anything else is a ValueError. An empty table gives
    an empty result; no other column is read.
    """
    spark = vectors.sparkSession
    rows = usable_rows(vectors, vec_id=vec_id, vector=vector, label=label)
    id_type, label_type = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    empty = spark.createDataFrame([], f"vec_id {id_type}, label {label_type}, codes array<int>, error bigint")
    shape = measure(rows, scale)
    if not shape.rows:
        return empty, Codebooks(np.empty((parts, 0, 0), np.int64))
    dim = one_length(shape)
    if dim % parts:
        raise ValueError(f"vectors of length {dim} cannot be cut into {parts} equal parts")
    exact = _exact_kind(shape, dim // parts)
    book = _start(rows.withColumn("vec_id", F.col("vec_id").cast("bigint")), scale, parts, entries)
    if not book.shape[1]:
        return empty, Codebooks(book)
    fixed = np.stack([own[np.resize(pivots_of(own, pivots), pivots)] for own in book])
    stored = stage(_stored(rows, scale, shape, fixed), "code-parts")
    for _ in range(rounds):
        book = _round(stored, _Coder(book, fixed, shape.kind, exact))
    coder = _Coder(book, fixed, shape.kind, exact)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                _, codes, errors = coder.run(batch)
                lists = pa.ListArray.from_arrays(np.arange(0, codes.size + 1, parts, dtype=np.int32), pa.array(codes.ravel(), pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), lists, pa.array(errors.sum(axis=1))], names=["vec_id", "label", "codes", "error"])

    return stage(stored.mapInArrow(run, empty.schema), "codes"), Codebooks(book)


def _stored(rows: DataFrame, scale: int, shape: Shape, pivots: np.ndarray) -> DataFrame:
    """(vec_id, label, x, near): whole vectors, and the distances of their parts to the pivots."""
    id_type, label_type = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    parts = len(pivots)

    def run(batches):
        for batch in batches:
            for at, x in whole(batch.column("vector"), scale):
                own = x.reshape(len(x), parts, -1)
                near = np.stack([distances(own[:, p], pivots[p]) for p in range(parts)], axis=1)
                part = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), binary(x.astype(shape.kind)), binary(near.reshape(len(x), -1).astype(np.float32))],
                    names=["vec_id", "label", "x", "near"],
                )

    return rows.mapInArrow(run, f"vec_id {id_type}, label {label_type}, x binary, near binary")


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``: the error summed over equal labels, nulls together.
    Errors are summed before labels meet their rows, and a hot label's rows are sliced."""
    keyed = codes.withColumn("_key", label_key(F.col("label")))
    sums = stage(keyed.groupBy("_key").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors")
    joined = lookup_join(keyed, sums.drop("n"), "_key", key_counts=sums.select("_key", "n"))
    return joined.select(*codes.columns, "label_error")


def code_rows(spark: SparkSession, codes: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): codes as two hex digits each."""
    digits = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c.cast("bigint"))), 2, "0"))
    return with_label_errors(codes).select(
        "vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
