"""Forests from binned rows: what they draw, where rows go, and MLlib's forest beside them."""

import os

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from starledger.plans import binned, training, trees
from starledger.plans.forest import fit_forest
from starledger.session import fresh_path, workspace


def _rows():
    """(vector, label): a measure with more values than bins, small ones, negative ones, and of
    the seldom set slots none, one or two."""
    random = np.random.default_rng(7)
    for i in range(4000):
        v = np.zeros(20)
        v[:3] = random.integers(0, 200), random.integers(0, 7), random.integers(-3, 4)
        for kind in random.choice(16, i % 3, replace=False):
            v[4 + kind] = 1 + kind % 2 * (i % 4)
        yield i, v, float(v[0] * 0.013 + v[1] * (1.7 if v[5] else -0.9) + v[2] ** 2 * 0.31 + v[8] + random.normal())


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, Vectors.dense(v) if i % 3 else Vectors.sparse(20, {k: x for k, x in enumerate(v) if x}), y) for i, v, y in _rows()]
    return spark.createDataFrame(data, ["id", "features", "label"]).repartition(3)


def _estimator(**settings):
    return RandomForestRegressor(featuresCol="features", labelCol="label", predictionCol="prediction", seed=42, **settings)


def test_draws_follow_the_law_and_repeat():
    draw = binned.weigher(42)
    many = np.concatenate([draw(3, block, 50_000) for block in range(20)])
    found = np.bincount(many, minlength=8)[:8] / len(many)
    law = np.exp(-1.0) / np.cumprod([1.0, *range(1, 8)])
    assert np.abs(found - law).max() < 0.002 and many.max() < 20
    assert (draw(3, 5, 100) == many[250_000:250_100]).all()
    assert not (draw(3, 5, 100) == draw(4, 5, 100)).all()


@pytest.mark.parametrize("at_once", [1, 64])
def test_rows_go_where_the_splits_send_them(spark, rows, monkeypatch, at_once):
    """Node by node and by tables, with several loose slots in a row, of all rows and of some."""
    monkeypatch.setattr(binned, "NODES_AT_ONCE", at_once)
    b = binned.find_binning(rows, "features", 4000, 42)
    assert b.columns and any(f not in b.columns and len(c) > 1 for f, c in enumerate(b.thresholds))
    block = binned.binned_blocks(rows.coalesce(1).orderBy("id"), b, "features", "label").toArrow().combine_chunks().to_batches()[0]
    random, tree = np.random.default_rng(1), binned.Tree(6)
    for p in range(1, 64):
        slot = int(random.choice([f for f, c in enumerate(b.thresholds) if len(c)]))
        if p == 1 or p // 2 in tree.split and p % 5:
            tree.split[p] = (slot, int(random.integers(0, len(b.thresholds[slot]))))
    n, _, held, loose = binned.reader(b)(block, 0)
    assert n == 4000 and len(loose) == 2
    prepared, place = binned.router(b)
    want = []
    for _, v, _ in _rows():
        p = 1
        for _ in range(6):
            slot, last = tree.split.get(p, (0, None))
            p = 2 * p + int(last is not None and v[slot] > b.thresholds[slot][last])
        want.append(p - 64)
    route = prepared(binned.steps(tree, b, 6))
    assert len(set(want)) > 15
    assert place(held, loose, route, None).tolist() == want
    some = np.arange(1, 4000, 3)
    assert place(held, loose, route, some).tolist() == [want[i] for i in some]


@pytest.mark.parametrize("cells", [1, 1 << 15])
def test_forest_is_as_good_as_that_of_mllib(spark, rows, monkeypatch, cells):
    monkeypatch.setattr(binned, "JOINT_CELLS", cells)
    monkeypatch.setattr(binned, "BLOCK_ROWS", 700)
    before = set(os.listdir(workspace(spark).removeprefix("file:")))
    own, theirs = (fit(_estimator(numTrees=30, maxDepth=8)) for fit in (lambda e: fit_forest(rows, e), lambda e: e.fit(rows)))
    assert set(os.listdir(workspace(spark).removeprefix("file:"))) == before
    assert type(own) is type(theirs) and own.getNumTrees == 30 and own.getOrDefault("maxDepth") == 8
    assert max(t.depth for t in own.trees) == 8
    error = [m.transform(rows).agg(F.avg((F.col("prediction") - F.col("label")) ** 2)).first()[0] for m in (own, theirs)]
    assert error[0] == pytest.approx(error[1], rel=0.1)
    assert own.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=0.06)
    assert 0.8 < sum(t.numNodes for t in own.trees) / sum(t.numNodes for t in theirs.trees) < 1.25


def test_every_node_holds_what_its_tree_has_drawn(spark, rows):
    """Rows, means and gains of all nodes are those of the drawn rows, added up anew."""
    estimator = _estimator(numTrees=3, maxDepth=4)
    model, again = (fit_forest(rows, estimator) for _ in range(2))
    assert model.toDebugString.split("\n")[1:] == again.toDebugString.split("\n")[1:]
    b = binned.find_binning(rows, "features", 4000, 42)
    blocks = binned.staged_blocks(rows, b, "features", "label").collect()
    path = fresh_path(spark, "forest")
    training.save_model(model, path)
    nodes = {(r.tree, r.node): r for r in trees.node_table(spark, path).collect()}
    draw, read, base = binned.weigher(42), binned.reader(b), 1 << 31
    import pyarrow as pa

    for t in range(3):
        labels, weights, tables = [], [], []
        for r in blocks:
            batch = pa.RecordBatch.from_pydict({k: pa.array([r[k]], pa.int32() if k == "rows" else pa.binary()) for k in ("rows", "residual", "columns", "loose")})
            n, label, held, loose = read(batch, 0)
            labels.append(label)
            weights.append(draw(t, r.block, n))
            bins = np.zeros((n, len(b.thresholds)), int) + b.zero
            bins[:, b.columns] = held.T
            for f in [f for f, c in enumerate(b.thresholds) if len(c) and f not in b.columns]:
                for own in loose:
                    hit = (own >= b.base[f]) & (own <= b.base[f] + len(b.thresholds[f]))
                    bins[hit, f] = own[hit] - b.base[f]
            tables.append(bins)
        y, w, bins = np.concatenate(labels), np.concatenate(weights), np.concatenate(tables)
        todo = [(0, np.ones(len(y), bool))]
        while todo:
            node, here = todo.pop()
            r = nodes[t, node]
            mean = np.average(y[here], weights=w[here])
            assert r.rows == w[here].sum() and r.prediction == pytest.approx(mean, abs=1e-9)
            if r.left is not None:
                last = int(np.flatnonzero(b.thresholds[r.feature] == r.threshold)[0])
                sides = [here & (bins[:, r.feature] <= last), here & (bins[:, r.feature] > last)]
                parts = [(w[s].sum(), np.average(y[s], weights=w[s])) for s in sides]
                gain = sum(n * (m - mean) ** 2 for n, m in parts) / r.rows
                assert r.gain == pytest.approx(gain, rel=1e-6)
                todo += [(r.left - t * base, sides[0]), (r.right - t * base, sides[1])]


def test_large_tables_grow_from_binned_rows(rows, monkeypatch):
    used = []
    monkeypatch.setattr(training, "BINNED_ROWS", 3999)
    monkeypatch.setattr(training, "fit_forest", lambda *a: used.append(a) or fit_forest(*a))
    assert training.fit_regressor(rows, training.FOREST, {"numTrees": 2, "maxDepth": 2}).getNumTrees == 2
    monkeypatch.setattr(training, "BINNED_ROWS", 4000)
    training.fit_regressor(rows, training.FOREST, {"numTrees": 2, "maxDepth": 2})
    assert len(used) == 1


def test_constant_label_and_no_rows(rows):
    flat = fit_forest(rows.withColumn("label", F.lit(2.5)), _estimator(numTrees=2, maxDepth=3))
    assert {t.numNodes for t in flat.trees} == {1} and flat.transform(rows).agg(F.max("prediction")).first()[0] == 2.5
    with pytest.raises(ValueError):
        fit_forest(rows.limit(0), _estimator())
    with pytest.raises(ValueError):
        fit_forest(rows, _estimator(numTrees=2, subsamplingRate=0.5))
