"""Regression trees grown from binned rows, and saved as MLlib's own models.

MLlib keeps each training row with one 32-bit number per slot of its vector, and adds it up slot
by slot. Here a row is one byte per slot that is seldom at zero, one number per other slot that
is not, and its target. A pass of all rows adds up histograms of a whole level, of all trees.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.base import Estimator, Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.session import GROUP_BYTES, stage, temporary_path

#: As MLlib: bins of a slot, and the expected number of rows that its thresholds are found on.
BINS, THRESHOLD_ROWS = 32, 10_000
#: Rows of a block, and of the batches it is gathered from. The rows of a block have 16-bit numbers.
BLOCK_ROWS, BATCH_ROWS = 1 << 15, 256
#: Blocks of rows that a worker takes at a time, and tasks of a pass per core. A pass streams
#: its rows, so that its tasks may be large; each gives one histogram per tree.
BATCH_BLOCKS, TASKS_PER_CORE = 8, 2
#: A slot is kept as a column where more than this share of the rows is not in the bin of zero.
COLUMN_SHARE = 1 / 4
#: Columns are counted together while their joint bins, times the nodes, are no more than this:
#: one addition instead of several, in counters that stay in a core's cache.
JOINT_CELLS = 1 << 12
#: Levels of up to this many nodes are passed node by node, all rows at once, others by tables.
NODES_AT_ONCE = 32
#: Share of the root's mean square that rounding may leave as a gain.
NOISE = 1e-12


@dataclass(frozen=True)
class Binning:
    """Ascending thresholds of every slot, and how binned rows are stored.

    The bin of a value is the number of thresholds beneath it. ``columns`` are slots stored
    for every row; all others are loose: bin b of such a slot has the code ``base`` + b, and
    is stored where it is not the bin of zero. Code 0 stands for no entry.
    """

    thresholds: list[np.ndarray]
    columns: list[int]
    zero: np.ndarray
    base: np.ndarray
    codes: int

    @property
    def widths(self) -> list[int]:
        """The bins of every column."""
        return [len(self.thresholds[f]) + 1 for f in self.columns]


@dataclass
class Tree:
    """A tree by heap place (root 1, children 2p and 2p + 1)."""

    depth: int
    split: dict[int, tuple[int, int]] = field(default_factory=dict)  # slot, last bin to the left
    stats: dict[int, tuple[float, float]] = field(default_factory=dict)  # rows, sum
    gain: dict[int, float] = field(default_factory=dict)
    squares: dict[int, float] = field(default_factory=dict)
    noise: float = 0.0
    #: The histograms of the last level grown, by heap place.
    held: dict[int, np.ndarray] = field(default_factory=dict)

    def prediction(self, place: int) -> float:
        rows, total = self.stats[place]
        return total / rows

    def growing(self, level: int) -> list[int]:
        """The places of a level that rows get to."""
        return [p for p in range(1 << level, 2 << level) if not level or p // 2 in self.split]

    def counted(self, level: int) -> list[int]:
        """Those of them whose rows are added up: of two children the one with fewer rows. The
        other one is what is left of their parent."""
        if not level:
            return [1]
        return [2 * p + int(self.stats[2 * p + 1][0] < self.stats[2 * p][0]) for p in self.split if p.bit_length() == level]


def slot_thresholds(values: np.ndarray, counts: np.ndarray, bins: int = BINS) -> np.ndarray:
    """MLlib's thresholds of a slot from its ascending distinct values and their counts: all
    midpoints where there are fewer than ``bins``, else those nearest to even shares."""
    if len(values) <= bins:
        return (values[1:] + values[:-1]) / 2
    stride = counts.sum() / bins
    out, seen, target = [], float(counts[0]), stride
    for i in range(1, len(values)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            out.append((values[i - 1] + values[i]) / 2)
            target += stride
    return np.array(out)


def find_binning(train: DataFrame, features: str, rows: int, seed: int) -> Binning:
    """Thresholds from about ``THRESHOLD_ROWS`` rows, as MLlib finds them; all rows are then
    binned by them. Slots that the vector's metadata calls binary are cut between 0 and 1."""
    few = train if rows <= THRESHOLD_ROWS else train.sample(THRESHOLD_ROWS / rows, seed)
    vectors = [r[0] for r in few.select(features).collect()] or [train.select(features).first()[0]]
    size = len(vectors[0])
    attrs = train.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    if attrs.get("nominal"):
        raise ValueError("slots of more than two categories are not handled")
    binary = {a["idx"] for a in attrs.get("binary", [])}
    found: list[list[float]] = [[] for _ in range(size)]
    for v in vectors:
        pairs = zip(v.indices, v.values, strict=True) if hasattr(v, "indices") else enumerate(v.values)
        for slot, value in pairs:
            if value:
                found[slot].append(value)
    thresholds, columns, base, codes = [], [], np.zeros(size, np.int64), 1
    zero = np.zeros(size, np.int64)
    for slot, own in enumerate(found):
        every = np.concatenate([own, np.zeros(len(vectors) - len(own))])
        cuts = np.array([0.5]) if slot in binary else slot_thresholds(*np.unique(every, return_counts=True))
        thresholds.append(cuts)
        zero[slot] = np.searchsorted(cuts, 0.0)
        if not len(cuts):
            continue
        if (np.searchsorted(cuts, every) != zero[slot]).mean() > COLUMN_SHARE:
            columns.append(slot)
        else:
            base[slot] = codes
            codes += len(cuts) + 1
    return Binning(thresholds, columns, zero, base, codes)


def binned_blocks(train: DataFrame, b: Binning, features: str, label: str) -> DataFrame:
    """(rows, residual, columns, loose): a block of rows as arrays, the label as first residual."""
    thresholds, columns, zero, base = b.thresholds, b.columns, b.zero, b.base
    size, kind, most = len(thresholds), "<u2" if b.codes < 1 << 16 else "<u4", BLOCK_ROWS
    # Sorting 16-bit numbers takes a step per number.
    number = np.uint16 if size <= 1 << 16 else np.int64

    # Nested, so that workers need numpy and pyarrow but not this package.
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def gathered():
            held, n = [], 0
            for batch in batches:
                while batch.num_rows:
                    taken = batch.slice(0, most - n)
                    held.append(taken)
                    n += taken.num_rows
                    batch = batch.slice(taken.num_rows)
                    if n == most:
                        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                        held, n = [], 0
            if held:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()

        for batch in gathered():
            n = batch.num_rows
            if not n:
                continue
            kinds, _, indices, values = batch.column(0).flatten()
            lengths = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
            value = values.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(n, dtype=np.uint16), lengths)
            slot = np.arange(len(value)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            slot[np.repeat(kinds.to_numpy(zero_copy_only=False) == 0, lengths)] = indices.flatten().to_numpy(zero_copy_only=False)
            slot = slot.astype(number)
            order = np.argsort(slot, kind="stable")
            row, slot, value = row[order], slot[order], value[order]
            ends = np.searchsorted(slot, np.arange(size + 1))
            held = np.empty((len(columns), n), np.uint8)
            for i, f in enumerate(columns):
                own = slice(ends[f], ends[f + 1])
                held[i] = zero[f]
                held[i, row[own]] = np.searchsorted(thresholds[f], value[own])
            rows, codes = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
            for f in np.flatnonzero((base > 0) & (ends[1:] > ends[:-1])):
                own = slice(ends[f], ends[f + 1])
                bins = np.searchsorted(thresholds[f], value[own])
                far = bins != zero[f]
                rows.append(row[own][far])
                codes.append(base[f] + bins[far])
            rows, codes = np.concatenate(rows), np.concatenate(codes)
            order = np.argsort(rows, kind="stable")
            rows, codes = rows[order], codes[order]
            each = np.bincount(rows, minlength=n)
            loose = np.zeros((each.max(), n), kind)
            loose[np.arange(len(rows)) - np.repeat(np.cumsum(each) - each, each), rows] = codes
            label = batch.column(1).to_numpy(zero_copy_only=False).astype("<f8")
            yield pa.RecordBatch.from_pydict(
                {"rows": pa.array([n], pa.int32()), **{k: pa.array([v.tobytes()], pa.binary()) for k, v in (("residual", label), ("columns", held), ("loose", loose))}}
            )

    rows = train.select(F.unwrap_udt(features).alias("features"), F.col(label).cast("double").alias("label"))
    return rows.mapInArrow(run, "rows int, residual binary, columns binary, loose binary")


def staged_blocks(train: DataFrame, b: Binning, features: str, label: str) -> DataFrame:
    """The binned rows, written once, in large tasks; ``block`` tells blocks apart."""
    spark = train.sparkSession
    with arrow_batches(spark, BATCH_ROWS):
        blocks = binned_blocks(train, b, features, label).withColumn("block", F.monotonically_increasing_id())
        return stage(blocks, "blocks", GROUP_BYTES).coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def steps(tree: Tree, b: Binning, levels: int) -> list[list[tuple[int, int, int, int, bool]]]:
    """Per level, the splits as (place in the level, column or -1, least, most, turned): a row
    goes right where its bin, or any of its codes, is in [least, most], or if turned where not."""
    out: list[list] = [[] for _ in range(levels)]
    for place, (slot, last) in sorted(tree.split.items()):
        level = place.bit_length() - 1
        if level >= levels:
            continue
        if slot in b.columns:
            step = (b.columns.index(slot), last + 1, BINS - 1, False)
        elif b.zero[slot] <= last:
            step = (-1, int(b.base[slot]) + last + 1, int(b.base[slot]) + len(b.thresholds[slot]), False)
        else:
            step = (-1, int(b.base[slot]), int(b.base[slot]) + last, True)
        out[level].append((place - (1 << level), *step))
    return out


def leaf_values(tree: Tree) -> np.ndarray:
    """The prediction per place of the deepest level; rows of a leaf above it go left."""
    out = np.zeros(1 << tree.depth)
    for place in tree.stats:
        if place not in tree.split:
            out[deepest(tree, place)] = tree.prediction(place)
    return out


def deepest(tree: Tree, leaf: int) -> int:
    """The place in the deepest level that the rows of a leaf are given."""
    return (leaf << (tree.depth - leaf.bit_length() + 1)) - (1 << tree.depth)


def reader(b: Binning):
    """A function for workers: (rows, residual, columns, loose) of a block of a batch."""
    width, kind = len(b.columns), "<u2" if b.codes < 1 << 16 else "<u4"

    def read(batch, i):
        import numpy as np

        n = batch.column(0)[i].as_py()
        residual, held, loose = (np.frombuffer(batch.column(k)[i].as_buffer(), t) for k, t in ((1, "<f8"), (2, np.uint8), (3, kind)))
        return n, residual, held.reshape(width, n), loose.reshape(-1, n)

    return read


def router(b: Binning):
    """A function for workers: the places of a block's rows after the levels given by ``steps``."""
    width, codes, bins, at_once = len(b.columns), b.codes, BINS, NODES_AT_ONCE

    def tables(level, nodes):
        """Per place: the source to read, and where its answers start; then the answers."""
        import numpy as np

        source, start = np.zeros(nodes, np.intp), np.zeros(nodes, np.intp)
        answers = [np.zeros(max(codes, bins), np.uint8)]
        at = len(answers[0])
        for place, column, least, most, turned in level:
            own = np.zeros(bins if column >= 0 else codes, np.uint8)
            own[least : most + 1] = 1
            source[place], start[place] = column if column >= 0 else width, at
            answers.append(1 - own if turned else own)
            at += len(own)
        return source, start, np.concatenate(answers), np.array([p for p, *_, turned in level if turned], np.intp)

    def prepared(levels):
        return [tables(level, 1 << i) if 1 << i > at_once else level for i, level in enumerate(levels)]

    def place(held, loose, levels, rows):
        """Of the rows numbered ``rows``, of all rows without."""
        import numpy as np

        n = held.shape[1]
        at = np.zeros(n, np.uint8)
        right, goes, same = np.empty(n, bool), np.empty(n, bool), np.empty(n, bool)
        whole = [level for level in levels if isinstance(level, list)]
        for level in whole:
            right[:] = False
            for node, column, least, most, turned in level:
                if column >= 0:
                    np.greater_equal(held[column], least, out=goes)
                elif least == most and len(loose) == 1:
                    np.equal(loose[0], least, out=goes)
                else:
                    goes[:] = False
                    for own in loose:
                        goes |= (own >= least) & (own <= most)
                if turned:
                    np.logical_not(goes, out=goes)
                np.equal(at, node, out=same)
                goes &= same
                right |= goes
            at <<= 1
            at |= right
        if rows is not None:
            at = at.take(rows)
        at = at.astype(np.intp)
        if len(whole) == len(levels):
            return at
        if rows is None:
            rows = np.arange(n)
        flat = np.concatenate([held, loose[:1] if len(loose) else np.zeros((1, n), np.uint8)], dtype=loose.dtype).ravel()
        for source, start, answers, turned in levels[len(whole) :]:
            which = source.take(at)
            code = flat.take(which * n + rows)
            first = start.take(at)
            right = answers.take(first + code)
            if len(loose) > 1:
                # Any of a row's codes may be in the range; beside it all codes are out of it.
                own = np.flatnonzero(which == width)
                flip = np.isin(at[own], turned)
                hit = right[own] ^ flip
                for more in loose[1:]:
                    hit |= answers.take(first[own] + more[rows[own]]) ^ flip
                right[own] = hit ^ flip
            at <<= 1
            at += right
        return at

    return prepared, place


def weigher(seed: int):
    """A function for workers: how often a tree draws each row of a block, by Poisson's law with
    the mean 1, always the same for a tree and a block. None where every row counts once."""
    # 2^32 equal draws; the first 16 bits settle nearly all of them.
    terms = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 20)]))
    ends = np.minimum(np.round(terms * 2.0**32), 2.0**32).astype(np.uint64)

    def weights(tree, block, n):
        import numpy as np

        random = np.random.Generator(np.random.SFC64([seed & 0xFFFFFFFF, tree, block]))
        high = random.integers(0, 1 << 16, n, dtype=np.uint16)
        out = table.take(high)
        open_ = np.flatnonzero(out == 255)
        draw = high[open_].astype(np.uint64) * 65536 + random.integers(0, 1 << 16, len(open_), dtype=np.uint64)
        out[open_] = np.searchsorted(ends, draw, side="right")
        return out

    first, last = (np.searchsorted(ends, np.arange(1 << 16, dtype=np.uint64) * 65536 + np.uint64(k), side="right") for k in (0, 65535))
    table = np.where(first == last, first, 255).astype(np.uint8)
    return weights


def joint_columns(widths: list[int], nodes: int) -> list[list[int]]:
    """Columns in groups that are counted together."""
    groups: list[list[int]] = []
    for i in sorted(range(len(widths)), key=lambda i: -widths[i]):
        for group in groups:
            if nodes * widths[i] * int(np.prod([widths[k] for k in group])) <= JOINT_CELLS:
                group.append(i)
                break
        else:
            groups.append([i])
    return groups


def level_histograms(blocks: DataFrame, b: Binning, trees: dict[int, Tree], level: int, scale: float = 1.0, seed: int | None = None) -> dict[int, tuple[float, np.ndarray]]:
    """Per tree: the sum of squares, at the root, and (2, nodes, cells): rows and sum of the target
    per ``counted`` node, in all, by column and bin, and by loose code.

    The target is ``scale`` times the residual. ``seed`` lets every tree draw its own rows.
    """
    read, (prepared, place), weights = reader(b), router(b), None if seed is None else weigher(seed)
    widths, codes = b.widths, b.codes
    cells = 1 + sum(widths) + codes
    plans = {}
    for t, tree in trees.items():
        own = tree.counted(level)
        index = np.full(1 << level, -1, np.intp)
        index[[p - (1 << level) for p in own]] = np.arange(len(own))
        plans[t] = (steps(tree, b, level), index, len(own))
    groups = joint_columns(widths, max(n for _, _, n in plans.values()))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        sizes = [int(np.prod([widths[i] for i in g])) for g in groups]
        routes = {t: prepared(levels) for t, (levels, _, _) in plans.items()}
        found = {t: [np.zeros((2, n * size)) for size in (1, *sizes, codes)] for t, (_, _, n) in plans.items()}
        square = dict.fromkeys(plans, 0.0)

        def add(into, at, size, own, kept, w, target):
            key = at if own is None else own if kept is None else own.take(kept)
            if own is not None and into.shape[1] > size:
                key = at * size + key
            if into.shape[1] > len(key):
                np.add.at(into[0], key, np.ones(len(key)) if w is None else w)
                np.add.at(into[1], key, target)
            else:
                into[0] += np.bincount(key, w, into.shape[1])
                into[1] += np.bincount(key, target, into.shape[1])

        for batch in batches:
            opened = []
            for i in range(batch.num_rows):
                n, residual, held, loose = read(batch, i)
                keys = []
                for g in groups:
                    key = held[g[0]].astype(np.uint16)
                    for k in g[1:]:
                        key *= widths[k]
                        key += held[k]
                    keys.append(key)
                opened.append((batch.column("block")[i].as_py(), n, scale * residual if scale != 1 else residual, held, loose, keys))
            for t, (_, index, nodes) in plans.items():
                own = found[t]
                for block, n, target, held, loose, keys in opened:
                    w = None if weights is None else weights(t, block, n)
                    kept = None if w is None else np.flatnonzero(w != 0)
                    at = index.take(place(held, loose, routes[t], kept))
                    if routes[t]:
                        counted = np.flatnonzero(at >= 0)
                        at, kept = at.take(counted), counted if kept is None else kept.take(counted)
                    if kept is not None:
                        target = target.take(kept)
                    if w is not None:
                        w = w.take(kept).astype(np.float64)
                    once = target if w is None else w * target
                    if not level:
                        square[t] += float((once * target).sum())
                    add(own[0], at, 1, None, kept, w, once)
                    for key, size, into in zip(keys, sizes, own[1:]):
                        add(into, at, size, key, kept, w, once)
                    for more in loose:
                        add(own[-1], at, codes, more, kept, w, once)
        for t, (_, _, nodes) in plans.items():
            out, start = np.zeros((2, nodes, cells)), 1
            out[:, :, 0] = found[t][0]
            starts = np.cumsum([1, *widths])
            for g, into in zip(groups, found[t][1:]):
                joint = into.reshape(2, nodes, *[widths[k] for k in g])
                for axis, k in enumerate(g):
                    out[:, :, starts[k] : starts[k] + widths[k]] = joint.sum(axis=tuple(a + 2 for a in range(len(g)) if a != axis))
            out[:, :, starts[-1] :] = found[t][-1].reshape(2, nodes, codes)
            yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "v": pa.array([np.append(out.ravel(), square[t]).tobytes()], pa.binary())})

    summed = _summed(blocks.mapInArrow(run, "tree int, v binary"), trees)
    return {t: (float(v[-1]), v[:-1].reshape(2, plans[t][2], cells)) for t, v in summed.items()}


def _summed(parts: DataFrame, trees: Iterable[int]) -> dict[int, np.ndarray]:
    """The sum per tree of the arrays that the tasks give. Those of many trees are added up by
    workers, so that the driver gets one for each."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = {}
        for batch in batches:
            for i in range(batch.num_rows):
                t, own = batch.column(0)[i].as_py(), np.frombuffer(batch.column(1)[i].as_buffer(), np.float64)
                if t in total:
                    total[t] += own
                else:
                    total[t] = own.copy()
        for t, own in total.items():
            yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "v": pa.array([own.tobytes()], pa.binary())})

    if len(trees := list(trees)) > 1:
        tasks = min(len(trees), parts.sparkSession.sparkContext.defaultParallelism)
        parts = parts.repartition(tasks, "tree").mapInArrow(run, parts.schema)
    out: dict[int, np.ndarray] = {}
    for r in parts.collect():
        out[r.tree] = out[r.tree] + np.frombuffer(r.v, np.float64) if r.tree in out else np.frombuffer(r.v, np.float64)
    return out


def leaf_sums(blocks: DataFrame, b: Binning, trees: dict[int, Tree], scale: float = 1.0, seed: int | None = None) -> dict[int, np.ndarray]:
    """Per tree (3, places of the deepest level): rows, sum and squares of the target."""
    read, (prepared, place), weights = reader(b), router(b), None if seed is None else weigher(seed)
    levels = {t: (steps(tree, b, tree.depth), 1 << tree.depth) for t, tree in trees.items()}

    def run(batches):
        import numpy as np
        import pyarrow as pa

        routes = {t: (prepared(own), places) for t, (own, places) in levels.items()}
        total = {t: np.zeros((3, places)) for t, (_, places) in levels.items()}
        for batch in batches:
            for i in range(batch.num_rows):
                n, residual, held, loose = read(batch, i)
                target, block = scale * residual, batch.column("block")[i].as_py()
                for t, (route, places) in routes.items():
                    w, kept, own = None, None, target
                    if weights is not None:
                        w = weights(t, block, n)
                        kept = np.flatnonzero(w != 0)
                        w, own = w.take(kept).astype(np.float64), target.take(kept)
                    at, once = place(held, loose, route, kept), own if w is None else w * own
                    for m, v in enumerate((w, once, once * own)):
                        total[t][m] += np.bincount(at, v, places)
        for t, own in total.items():
            yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "v": pa.array([own.tobytes()], pa.binary())})

    summed = _summed(blocks.mapInArrow(run, "tree int, v binary"), trees)
    return {t: v.reshape(3, -1) for t, v in summed.items()}


class Splitter:
    """Finds the splits of a level from its histograms."""

    def __init__(self, b: Binning):
        self.b = b
        starts = np.cumsum([1, *b.widths])
        self.slots = [f for f, cuts in enumerate(b.thresholds) if len(cuts)]
        self.size = len(b.thresholds)
        self.cells = 1 + sum(b.widths) + b.codes
        #: The cell of each slot's bin; the last one, added here, is always empty.
        self.at = np.full((len(self.slots), BINS), self.cells)
        self.cut = np.zeros((len(self.slots), BINS), bool)
        self.loose = np.array([f not in b.columns for f in self.slots], bool)
        for i, f in enumerate(self.slots):
            first, many = (starts[-1] + b.base[f]) if self.loose[i] else starts[b.columns.index(f)], len(b.thresholds[f])
            self.at[i, : many + 1] = first + np.arange(many + 1)
            self.cut[i, :many] = True
        self.zero = b.zero[self.slots]

    def grow(self, tree: Tree, level: int, squares: float, counted: np.ndarray, chosen=None) -> None:
        """Split each node of ``level`` where MLlib would: at the greatest gain in variance.

        ``chosen`` gives for a node the slots that may split it; all of them without.
        """
        held = {p: counted[:, i] for i, p in enumerate(tree.counted(level))}
        for p in list(held) if level else []:
            held[p ^ 1] = tree.held[p // 2] - held[p]
        tree.held = held
        if not level:
            rows, total = (float(v) for v in held[1][:, 0])
            tree.stats[1], tree.noise = (rows, total), NOISE * squares / rows if rows else 0.0
        for p in sorted(held) if self.slots else []:
            self._split(tree, p, held[p], None if chosen is None else np.isin(self.slots, chosen()))

    def _split(self, tree: Tree, p: int, found: np.ndarray, chosen: np.ndarray | None) -> None:
        n, s = tree.stats[p]
        if not n:
            return
        own = np.concatenate([found, np.zeros((2, 1))], axis=1)[:, self.at]
        loose = np.flatnonzero(self.loose)
        own[:, loose, self.zero[loose]] += found[:, :1] - own[:, loose].sum(axis=2)
        left_n, left_s = own.cumsum(axis=2)
        right_n, right_s = n - left_n, s - left_s
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (left_s**2 / left_n + right_s**2 / right_n - s * s / n) / n
        gain[~self.cut | (left_n < 0.5) | (right_n < 0.5)] = -1.0
        if chosen is not None:
            gain[~chosen] = -1.0
        i, k = np.unravel_index(int(gain.argmax()), gain.shape)
        if gain[i, k] <= tree.noise:
            return
        tree.split[p], tree.gain[p] = (self.slots[i], int(k)), float(gain[i, k])
        tree.stats[2 * p], tree.stats[2 * p + 1] = (float(left_n[i, k]), float(left_s[i, k])), (float(right_n[i, k]), float(right_s[i, k]))


def settle(tree: Tree, sums: np.ndarray, whole: bool) -> None:
    """Give every node its sum of squares from those of its leaves; if ``whole`` also rows and
    sum, which at small nodes are then free of what subtracting from large ones leaves."""
    for p in sorted(tree.stats, reverse=True):
        if p in tree.split:
            below = (2 * p, 2 * p + 1)
            tree.squares[p] = sum(tree.squares[c] for c in below)
            if whole:
                tree.stats[p] = tuple(sum(tree.stats[c][m] for c in below) for m in range(2))
        else:
            n, s, q = (float(v) for v in sums[:, deepest(tree, p)])
            tree.squares[p] = q
            if whole:
                tree.stats[p] = (n, s)
    tree.held = {}


def _node_rows(tree: Tree, number: int, b: Binning) -> list[tuple]:
    """The tree as MLlib saves it: nodes numbered from the root, left before right."""
    rows: list = []

    def add(place: int) -> int:
        own = len(rows)
        rows.append(None)
        (n, s), q = tree.stats[place], tree.squares[place]
        children, gain, split = (-1, -1), -1.0, (-1, [], -1)
        if place in tree.split:
            slot, last = tree.split[place]
            children, gain = (add(2 * place), add(2 * place + 1)), tree.gain[place]
            split = (slot, [float(b.thresholds[slot][last])], -1)
        impurity = max(0.0, q / n - (s / n) ** 2)
        rows[own] = (number, (own, s / n, impurity, [n, s, q], round(n), gain, *children, split))
        return own

    add(1)
    return rows


def as_model(spark: SparkSession, kind: type[Model], estimator: Estimator, trees: list[Tree], weights: list[float], b: Binning) -> Model:
    """MLlib's model of these trees, read from files in its own saved form."""

    def metadata(name: str, uid: str, names: set[str] | None = None, **more) -> str:
        params = [{p.name: v for p, v in m.items() if names is None or p.name in names} for m in (estimator._paramMap, estimator._defaultParamMap)]
        own = {"class": f"org.apache.spark.ml.regression.{name}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid}
        return json.dumps({**own, "paramMap": params[0], "defaultParamMap": params[1], **more})

    path = temporary_path(spark, "grown")
    nodes = [row for i, tree in enumerate(trees) for row in _node_rows(tree, i, b)]
    split = "struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>"
    node = f"struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, leftChild: int, rightChild: int, split: {split}>"
    spark.createDataFrame(nodes, f"treeID int, nodeData {node}").coalesce(1).write.parquet(f"{path}/data")
    single = {"featuresCol", "labelCol", "predictionCol", "maxDepth", "maxBins", "seed", "impurity", "minInstancesPerNode", "minInfoGain"}
    about = [(i, metadata("DecisionTreeRegressionModel", f"dtr_{estimator.uid}_{i}", single), w) for i, w in enumerate(weights)]
    spark.createDataFrame(about, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    whole = metadata(kind.__name__, estimator.uid, numFeatures=len(b.thresholds), numTrees=len(trees))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return kind.load(path)


def require(estimator: Estimator, own: dict[str, object]) -> None:
    """Raise an error where a setting is not the one handled."""
    value = estimator.getOrDefault
    if other := {k: value(k) for k, v in own.items() if value(k) != v}:
        raise ValueError(f"not handled: {other}")
