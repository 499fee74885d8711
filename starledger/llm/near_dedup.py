"""Near-duplicates by MinHash bands and odd sketches, each link confirmed on full sets.

Only one document per shingle set is compared. Its MinHash samples are cut into bands; in
each bucket of a band every set is paired with a centre, not with every other set. A
pair's odd sketches, parity bitmaps of the samples, differ in a number of bits that tells
its similarity closely at the high end; what is clearly below the threshold is left out,
and each set is compared with the most similar of its centres on the full sets. Links
merge sets into components. What a bucket still holds of different components is then
compared exhaustively on the full sets, tile by tile, so no link between components is
lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.common import having_ids, is_small, lacking_ids, map_slices, text_bytes
from starledger.llm.graph import components
from starledger.llm.hashing import mix, numbers, word_hashes
from starledger.llm.tokens import bound_batches
from starledger.operators.joins import salted_join
from starledger.session import stage

#: Samples = bands x rows. At a similarity of 0.8 a pair shares no band with a chance of
#: (1 - 0.8^5)^40 = 1.3e-7, at 0.85 of 1e-10.
BANDS, ROWS = 40, 5
SAMPLES = BANDS * ROWS
#: Sets of fewer words than this many shingles need get a second hash of each shingle.
FEW_SHINGLES = 16
#: Bits of an odd sketch, as longs.
SKETCH_LONGS = 8
#: Two sketches of sets with a similarity of 0.8 differ in 69 bits on average, with a
#: standard deviation of 10; of unlike sets in 202. More than this and the pair is left out.
SKETCH_LIMIT = 150
#: Sets in a tile, and shingles in it, where what a bucket holds of different components is
#: compared. Every set goes to as many tasks as its bucket has tiles, so tiles are as large
#: as memory allows: a task holds two of them and a matrix of TILE x TILE counts.
TILE, TILE_SHINGLES = 1024, 1 << 19


def shingles(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text, A-Z in lower case.

    With fewer words than ``width``, the sequence as a whole is one shingle.
    """
    return [own for own, _ in _sets(texts, width)]


def _sets(texts: list[bytes], width: int):
    """Per text its shingles, and a number made from other hashes of them where they are few.

    Two unlike sets of many shingles cannot have all hashes alike; of a few they might, if
    there are billions of them.
    """
    lanes, counts = word_hashes([t.lower() for t in texts])
    factors = numbers(2, width)
    first = 0
    for n in counts.tolist():
        words = lanes[first : first + n]
        first += n
        if n == 0:
            yield words[:, 0], 0
            continue
        size = min(width, n)

        def combined(w: np.ndarray) -> np.ndarray:
            total = np.full(n - size + 1, size, np.uint64)
            for k in range(size):
                total += mix(w[k : k + len(total)] * factors[k] + np.uint64(k))
            return mix(total)

        if n < FEW_SHINGLES + width:
            own, at = np.unique(combined(words[:, 0]), return_index=True)
            yield own, int(mix(combined(words[:, 1])[at]).sum(dtype=np.uint64).view(np.int64))
        else:
            yield np.unique(combined(words[:, 0])), 0


def _samples(shingle_hashes: np.ndarray) -> np.ndarray:
    """The MinHash samples of one set, in steps that bound memory for large sets."""
    factors = (numbers(3, SAMPLES) | np.uint64(1))[:, None]
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingle_hashes), 2048):
        np.minimum(least, (factors * shingle_hashes[None, i : i + 2048]).min(axis=1), out=least)
    return least


def _bands(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, the band's number in it."""
    rows = samples.reshape(BANDS, ROWS)
    total = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(ROWS):
        total = mix(total + rows[:, k])
    return total.view(np.int64)


def _odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Each (sample number, value) flips one bit."""
    bits = 64 * SKETCH_LONGS
    place = (mix(samples ^ numbers(4, SAMPLES)) % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(place, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, sketch, bands) per row of docs (doc_id, text).

    f1 and f2 are two hashes of the set; equal sets have equal ones, and unlike sets do not.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, f1, f2, sketch, bands = [], [], [], [], []
        for own, other in _sets(text_bytes(batch.column("text")), width):
            n.append(len(own))
            f1.append(int(mix(own).sum(dtype=np.uint64).view(np.int64)))
            f2.append(int(mix(own ^ np.uint64(0xABCDEF)).sum(dtype=np.uint64).view(np.int64)) ^ other)
            samples = _samples(own) if len(own) else None
            sketch.append(_odd_sketch(samples) if len(own) else None)
            bands.append(_bands(samples) if len(own) else None)
        longs = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n, f1, f2)], pa.array(sketch, longs), pa.array(bands, longs)],
            names=["doc_id", "n_shingles", "f1", "f2", "sketch", "bands"],
        )

    return map_slices(
        docs, run, f"doc_id {id_type}, n_shingles bigint, f1 bigint, f2 bigint, sketch array<bigint>, bands array<bigint>"
    )


def _full_sets(docs: DataFrame, width: int) -> DataFrame:
    """(id, set): the sorted shingle hashes of each document."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [x.view(np.int64) for x in shingles(text_bytes(batch.column("text")), width)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], names=["id", "set"])

    return map_slices(docs, run, f"id {id_type}, set array<bigint>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * |intersection| >= percent * |union|."""
    joined = pairs.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    joined = joined.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    total = F.size("sa").cast("long") + F.size("sb")
    return joined.filter(100 * both >= percent * (total - both)).select("a", "b")


def _plausible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with ``odd``, the bits in which their sketches differ, that may be links."""
    for side in ("a", "b"):
        own = sets.select(F.col("id").alias(side), F.col("n_shingles").alias(f"n{side}"), F.col("sketch").alias(f"s{side}"))
        pairs = pairs.join(own, side)
    odd = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    sizes = F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb")
    return pairs.filter(sizes).select("a", "b", odd.alias("odd")).filter(F.col("odd") <= SKETCH_LIMIT)


def _across_components(held: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between different components of each bucket; held (band, id, component,
    tiles, set).

    A bucket is dealt into its number of tiles; two tiles meet in one task, where
    intersections are counted as products of incidence matrices. A task returns no more
    links than join its components, so the output is linear in the bucket.
    """
    tiles = F.col("tiles")
    dealt = held.withColumn("tile", F.pmod(F.xxhash64("id"), tiles).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    dealt = dealt.select("band", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "id", "component", "set")

    def compare(table: pa.Table) -> pa.Table:
        ids, parts, tile = (table.column(c).to_pylist() for c in ("id", "component", "tile"))
        lists = table.column("set").combine_chunks()
        values, edges = lists.values.to_numpy(), lists.offsets.to_numpy()
        sets = [np.sort(values[k:m]) for k, m in zip(edges[:-1], edges[1:])]
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        left = [k for k, t in enumerate(tile) if t == i]
        right = [k for k, t in enumerate(tile) if t == j]
        common = _intersections([sets[k] for k in left], [sets[k] for k in right])
        n = np.array([len(x) for x in sets])
        union = n[left][:, None] + n[right][None, :] - common
        a, b, root = [], [], {}

        def find(c):
            while root.get(c, c) != c:
                c = root[c]
            return c

        known = np.unique(parts, return_inverse=True)[1]  # components as small numbers
        apart = known[left][:, None] != known[right][None, :]
        for x, y in zip(*np.nonzero((100 * common >= percent * union) & apart)):
            p, q = left[x], right[y]
            cp, cq = find(parts[p]), find(parts[q])
            if cp != cq:
                root[max(cp, cq)] = min(cp, cq)
                a.append(min(ids[p], ids[q]))
                b.append(max(ids[p], ids[q]))
        return pa.table({"a": pa.array(a, table.schema.field("id").type), "b": pa.array(b, table.schema.field("id").type)})

    id_type = held.schema["id"].dataType.simpleString()
    return dealt.groupBy("band", "i", "j").applyInArrow(compare, f"a {id_type}, b {id_type}").distinct()


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, over the values that both sides have, some at a time."""
    if not left or not right:
        return np.zeros((len(left), len(right)), np.int64)
    values = np.intersect1d(np.concatenate(left), np.concatenate(right))
    total = np.zeros((len(left), len(right)), np.int64)
    for k in range(0, len(values), 4096):
        part = values[k : k + 4096]
        one, other = (_incidence(side, part) for side in (left, right))
        total += (one @ other.T).astype(np.int64)
    return total


def _incidence(sets: list[np.ndarray], values: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(values)), np.float32)
    for row, own in zip(out, sets):
        own = own[np.searchsorted(own, values[0]) : np.searchsorted(own, values[-1], "right")]
        place = np.searchsorted(values, own)
        row[place[values[place] == own]] = 1
    return out


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``.

    Documents are linked when their sets of ``width``-word shingles have a Jaccard
    similarity of ``percent`` or more; ``component_id`` is the least id reachable by links,
    and ``kept`` tells whether it is the document's own. Documents without words are linked
    with nothing. Rows with one id are one node. A null id is linked with nothing and kept.
    An empty table gives an empty result. No other column is read.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = stage(signatures(docs, width), "signatures")
    linked = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    of_set = linked.select("doc_id", F.struct("f1", "f2", "n_shingles").alias("_set"))
    classes = stage(of_set.groupBy("_set").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n")), "classes")
    # A set that many documents have is cut into slices.
    member = salted_join(of_set, classes.select("_set", "id"), "_set", "inner", classes.select("_set", "n"))
    member = stage(member.select("doc_id", "id").distinct(), "members")
    heads = member.filter("doc_id = id").select("doc_id")
    sets = linked.join(heads, "doc_id", "left_semi").select(
        F.col("doc_id").alias("id"), "n_shingles", "sketch", "bands"
    )
    # A set of s shingles and another, unlike it, have a similarity of s / (s + 1) at most. Where
    # that is too little the set is linked with equal ones alone.
    buckets = sets.filter(F.lit(100 - percent) * F.col("n_shingles") >= percent).select(
        "id", "n_shingles", F.explode("bands").alias("band")
    ).distinct()
    # The centre of a bucket is drawn by hash, so that a set meets many centres.
    centres = buckets.groupBy("band").agg(
        F.min_by("id", F.xxhash64("band", "id")).alias("centre"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1").drop("n")
    shared = stage(buckets.join(centres, "band"), "buckets")  # buckets of two sets or more
    found = shared.filter("id <> centre").select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"))
    pairs = stage(_plausible(found.distinct(), sets, percent), "pairs")
    wanted = stage(shared.select(F.col("id").alias("doc_id")).distinct(), "candidates")
    texts = having_ids(docs, wanted, "doc_id", is_small(wanted))
    full = stage(_full_sets(texts, width), "full-sets")

    # First each set with the most similar of its centres.
    best = pairs.groupBy("b").agg(F.min_by("a", F.struct("odd", "a")).alias("a")).select("a", "b")
    links = [stage(_confirmed(best, full, percent), "links")]
    merged = components(links[0])
    # Buckets that still hold several components: every pair across them, none within.
    held = shared.join(merged.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    tiles = F.ceil(F.greatest(F.count(F.lit(1)) / TILE, F.sum("n_shingles") / TILE_SHINGLES)).cast("int")
    mixed = held.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y"), tiles.alias("tiles")).filter("x < y").select("band", "tiles")
    held = stage(held.join(mixed, "band").select("band", "id", "component", "tiles"), "apart")
    if not held.isEmpty():
        links.append(stage(_across_components(held.join(full, "id"), percent), "links"))
        # Nodes of the first links are stars already, which saves rounds.
        stars = merged.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        merged = components(stars.unionByName(links[1]))
    # One node for an id that has several sets: their heads are linked through it.
    heads_of = member.join(merged.withColumnRenamed("node", "id"), "id", "left").select(
        "doc_id", F.coalesce("component", "id").alias("component_id")
    )
    labels = _per_id(heads_of)
    out = rows.select("doc_id", "n_shingles").join(labels, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def _per_id(labels: DataFrame) -> DataFrame:
    """(doc_id, component_id), one row per id; components that share an id become one."""
    labels = stage(labels.distinct(), "labels")
    shared = labels.groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.max("component_id").alias("_most"))
    if shared.filter("component_id < _most").isEmpty():
        return shared.drop("_most")
    joined = components(labels.join(shared, "doc_id").select(labels["component_id"].alias("a"), F.col("_most").alias("b")).filter("a <> b")
                        .unionByName(labels.select(F.col("component_id").alias("a"), F.col("doc_id").alias("b")).filter("a <> b")))
    return shared.drop("_most").join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", F.coalesce("component", "component_id").alias("component_id")
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that are near-duplicates of one with a smaller id; of rows
    with equal ids that are near-duplicates of each other one stays, any of them.

    Rows of one id are one node, so all go when one of them has a near-duplicate with a
    smaller id. Two rows of one id that are linked only through a dropped document both stay.
    """
    verdicts = near_duplicates(docs, doc_id, text, width, percent).filter("doc_id IS NOT NULL")
    per_id = verdicts.groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count_if(F.col("n_shingles") > 0).alias("n"))
    apart = stage(per_id.filter("NOT kept OR n > 1"), "gone")
    # Packed, so that columns of any name go through untouched.
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text")
    )
    left = lacking_ids(packed, apart.select(F.col("doc_id").alias("_id")), "_id", is_small(apart)).select("_doc.*")
    again = apart.filter("kept").select(F.col("doc_id").alias("_id"))
    if again.isEmpty():
        return left
    # Rows of repeated ids once more, each as a node of its own.
    rows = having_ids(packed, again, "_id", is_small(again)).withColumn("_row", F.monotonically_increasing_id())
    rows = stage(rows, "repeated")
    more = stage(near_duplicates(rows, "_row", "_text", width, percent).filter("NOT kept").select(F.col("doc_id").alias("_row")), "repeated-gone")
    return left.unionByName(lacking_ids(rows, more, "_row", is_small(more)).select("_doc.*"))
