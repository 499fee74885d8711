"""Gradient-boosted regression trees, grown from binned rows, as MLlib's own model."""

from __future__ import annotations

import numpy as np
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.plans.binned import BATCH_BLOCKS, BINS, TASKS_PER_CORE, Binning, Splitter, Tree, arrow_batches, as_model, binned_blocks, find_binning, leaf_sums, leaf_values, level_histograms, reader, require, router, settle, staged_blocks, steps
from starledger.session import GROUP_BYTES, stage, temporary_tables

__all__ = ["binned_blocks", "find_binning", "fit_boosted"]

#: Residuals are kept in the executors' memory, or their disks where that is full, from round
#: to round; after this many rounds they are written, which cuts their lineage.
ROUNDS_KEPT = 10


def fit_boosted(train: DataFrame, estimator: GBTRegressor) -> GBTRegressionModel:
    """The model of MLlib's ``GBTRegressor`` for squared errors, all rows and all slots.

    As there, the first tree fits the label and counts once; each later one fits twice the
    residual and counts by the step size. Rows are binned once. Each level of a tree is one
    pass that adds up histograms per node; the driver gets those and chooses the splits. Their
    size depends on slots, bins and nodes, and their number on the cores, not on the rows.
    """
    spark, value = train.sparkSession, estimator.getOrDefault
    require(estimator, {"lossType": "squared", "subsamplingRate": 1.0, "featureSubsetStrategy": "all", "maxBins": BINS, "minInstancesPerNode": 1, "minInfoGain": 0.0})
    features, label, depth, step = value("featuresCol"), value("labelCol"), value("maxDepth"), value("stepSize")
    with temporary_tables(spark):
        rows = train.count()
        if not rows:
            raise ValueError("no rows to fit")
        b = find_binning(train, features, rows, value("seed"))
        splitter = Splitter(b)
        blocks = staged_blocks(train, b, features, label).withColumn("sums", F.lit(None).cast("binary"))
        blocks.persist()
        trees: list[Tree] = []
        with arrow_batches(spark, BATCH_BLOCKS):
            for m in range(value("maxIter")):
                tree, spent, scale = Tree(depth), None, 2.0 if m else 1.0
                if m:
                    spent, blocks = blocks, _lessened(blocks, b, trees[-1], 2.0 if m > 1 else 1.0, step if m > 1 else 1.0)
                    if m % ROUNDS_KEPT == 0:
                        blocks = stage(blocks, "blocks", GROUP_BYTES).coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
                    blocks.persist()
                for level in range(depth):
                    if not tree.counted(level):
                        break
                    squares, counted = level_histograms(blocks, b, {0: tree}, level, scale)[0]
                    splitter.grow(tree, level, squares, counted)
                    if spent is not None and not level:
                        settle(trees[-1], _sums(blocks), whole=False)
                        spent.unpersist()
                trees.append(tree)
            settle(trees[-1], leaf_sums(blocks, b, {0: trees[-1]}, scale)[0], whole=False)
        blocks.unpersist()
        return as_model(spark, GBTRegressionModel, estimator, trees, [step if i else 1.0 for i in range(len(trees))], b)


def _sums(blocks: DataFrame) -> np.ndarray:
    """(3, places): what ``_lessened`` has added up, of all blocks."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        found = [np.frombuffer(v.as_buffer(), np.float64) for batch in batches for v in batch.column(0)]
        if found:
            yield pa.RecordBatch.from_pydict({"sums": pa.array([np.sum(found, axis=0).tobytes()], pa.binary())})

    return sum(np.frombuffer(r[0], np.float64) for r in blocks.select("sums").mapInArrow(run, "sums binary").collect()).reshape(3, -1)


def _lessened(blocks: DataFrame, b: Binning, tree: Tree, scale: float, weight: float) -> DataFrame:
    """The blocks with what the tree leaves of the residuals, and in ``sums`` the rows, sum and
    squares of its target per place of its deepest level."""
    read, (prepared, place), levels = reader(b), router(b), steps(tree, b, tree.depth)
    leaves, places = weight * leaf_values(tree), 1 << tree.depth

    def run(batches):
        import numpy as np
        import pyarrow as pa

        route = prepared(levels)
        for batch in batches:
            left, sums = [], []
            for i in range(batch.num_rows):
                _, residual, held, loose = read(batch, i)
                at = place(held, loose, route, None)
                target = scale * residual
                sums.append(np.concatenate([np.bincount(at, w, places) for w in (None, target, target * target)]).tobytes())
                left.append((residual - leaves.take(at)).tobytes())
            batch = batch.set_column(1, "residual", pa.array(left, pa.binary()))
            yield batch.set_column(batch.schema.get_field_index("sums"), "sums", pa.array(sums, pa.binary()))

    return blocks.mapInArrow(run, blocks.schema)
