"""Exact search, vector codes and whitening against plain numpy, with nulls, ties and odd vectors."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from starledger.llm.exact_search import top_k
from starledger.llm.vector_codes import code_rows, compress, distances, nearest, pivots_of
from starledger.llm.whitening import refined_eigenvectors, whiten

SCHEMA = "vec_id bigint, embedding array<float>, label string, number int, x string, tile double, query_id string"
CLASH = (7, "x", 0.5, "q")


def _rows(dim: int = 16, n: int = 240) -> list[tuple]:
    rnd = np.random.default_rng(11)
    base = rnd.normal(size=(12, dim))
    rows = []
    for i in range(n):
        v = base[i % 12] + rnd.normal(size=dim) * (0.3 if i % 4 else 0.0)  # many equal vectors
        rows.append([i, (v / np.linalg.norm(v)).astype("float32").tolist(), None if i % 7 == 0 else f"l{i % 3}"])
    odd = [None, [], [float("nan")] * dim, [float("inf")] + [0.0] * (dim - 1), [None] + [1.0] * (dim - 1)]
    rows += [[1000 + 50 * k, v, "l0"] for k, v in enumerate(odd)]
    rows += [[2000, [0.0] * dim, "l1"], [2050, [-0.0] * dim, "l1"], [50, rows[3][1], "l2"], [50, rows[3][1], "l2"], [None, rows[50][1], None]]
    return rows


def _df(spark, rows, parts: int = 4):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA).repartition(parts)


def _good(rows):
    fine = lambda v: v and all(x is not None and np.isfinite(x) for x in v)
    return [r for r in rows if fine(r[1])]


def _search(rows, k=5, every=50, scale=256):
    whole = [[int(np.floor(scale * np.float64(np.float32(x)))) for x in r[1]] for r in rows]
    out = []
    for i, q in enumerate(rows):
        if q[0] is None or q[0] % every:
            continue
        scores = [(-sum(a * b for a, b in zip(whole[i], whole[j])), rows[j][0] is None, rows[j][0]) for j in range(len(rows)) if j != i and len(whole[i]) == len(whole[j])]
        out += [(q[0], rank + 1, s[2], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("k, block", [(5, 8192), (5, 3), (1, 8192), (400, 8192)])
def test_search_equals_brute_force(spark, k, block):
    got = top_k(_df(spark, _rows()), k=k, block=block)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == _search(_good(_rows()), k)


def test_search_of_large_numbers_and_several_lengths_is_exact(spark):
    rnd = np.random.default_rng(3)
    rows = [[i, (rnd.normal(size=4 + i % 2) * (1e6 if i < 60 else 1e12)).astype("float32").tolist(), "a"] for i in range(120)]
    for part in (rows[:60], rows):
        want = [(q, r, v, int(np.clip(s, -(2**62) + 1, 2**62 - 1))) for q, r, v, s in _search(part)]
        got = sorted(map(tuple, top_k(_df(spark, part)).collect()), key=repr)
        if part is not rows:
            assert got == want
        else:  # beyond 2^62 scores are equal, and ties go to the smaller id
            assert [g[3] for g in got] == [w[3] for w in want]


def test_search_refines_histograms_of_many_close_scores(spark):
    """More scores in one bin than are left alone, for several rounds."""
    rnd = np.random.default_rng(8)
    one = rnd.normal(size=8) * 40
    rows = [[i, (one + rnd.normal(size=8) * 0.02).astype("float32").tolist(), "a"] for i in range(900)]
    rows += [[1000 + i, rows[0][1], "a"] for i in range(300)]
    assert sorted(map(tuple, top_k(_df(spark, rows)).collect()), key=repr) == _search(rows)


def _codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = _good(rows)
    x = np.array([[int(np.floor(scale * np.float64(np.float32(c)))) for c in r[1]] for r in kept], np.int64).reshape(len(kept), parts, -1)
    first = {}
    for i, r in enumerate(kept):
        if r[0] is not None:
            first[r[0]] = min(first.get(r[0], x[i].tolist()), x[i].tolist())
    book = np.array([first[i] for i in sorted(first)[:entries]], np.int64).transpose(1, 0, 2)

    def assigned():
        d = ((x[:, :, None, :] - book[None]) ** 2).sum(axis=3)
        return d.argmin(axis=2), d.min(axis=2).sum(axis=1)

    for _ in range(rounds):
        codes, _ = assigned()
        for p in range(parts):
            for e in range(book.shape[1]):
                own = x[codes[:, p] == e, p]
                if len(own):
                    book[p, e] = own.sum(axis=0) // len(own)
    codes, errors = assigned()
    totals = defaultdict(int)
    for r, e in zip(kept, errors.tolist()):
        totals[r[2]] += e
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{c:02x}" for c in own), e, totals[r[2]], digest) for r, own, e in zip(kept, codes.tolist(), errors.tolist())), key=repr)


@pytest.mark.parametrize("n", [240, 5])
def test_codes_equal_brute_force(spark, n):
    rows = _rows(n=n) if n > 50 else [r for r in _rows()[:n]]
    codes, books = compress(_df(spark, rows))
    got = code_rows(spark, codes, books)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == _codes(rows)


def test_pruned_assignment_is_exact_and_prunes():
    rnd = np.random.default_rng(2)
    centres = rnd.integers(-3000, 3000, size=(16, 8)).astype(np.float64)
    centres[9] = centres[4]  # a tie, to the lower index
    x = (centres[rnd.integers(0, 16, 4000)] + rnd.integers(-200, 200, size=(4000, 8))).astype(np.float64)
    pivots = centres[pivots_of(centres, 4)]
    code, best, work = nearest(x, distances(x, pivots).astype(np.float32), centres, distances(centres, pivots))
    d = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (code == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert work < 0.4 * d.size


def test_codes_of_odd_tables(spark):
    none, books = compress(_df(spark, [[1, None, "a"], [2, [float("nan")] * 8, "b"]]))
    assert code_rows(spark, none, books).isEmpty()
    assert code_rows(spark, *compress(_df(spark, [[None, [1.0] * 8, "a"]]))).isEmpty()
    with pytest.raises(ValueError, match="equal parts"):
        compress(_df(spark, [[1, [1.0] * 9, "a"]]))
    with pytest.raises(ValueError, match="one length"):
        compress(_df(spark, [[1, [1.0] * 8, "a"], [2, [1.0] * 16, "a"]]))
    with pytest.raises(ValueError, match="too large"):
        compress(_df(spark, [[1, [1e9] * 8, "a"]]))


def _whitened(rows, components=4):
    kept = _good(rows)
    x = np.array([[int(np.floor(256 * np.float64(np.float32(c)))) for c in r[1]] for r in kept], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    y = fit - sums / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1], axes[:, ::-1]
    w = (x - sums / n) @ axes[:, :components] / np.sqrt(values[:components])
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return kept, n, deviation, w, values[:components] / values.sum()


def test_whitening_equals_numpy(spark):
    rows = _rows()
    kept, n, deviation, w, share = _whitened(rows)
    got = whiten(_df(spark, rows)).collect()
    assert len(got) == 4 * len(kept)
    want = defaultdict(list)
    for r, d, own in zip(kept, deviation, w):
        want[r[0]].append((d, own))
    sign = {}
    for r in sorted(got, key=lambda r: -abs(r.whitened)):
        options = [own[r.component - 1] for d, own in want[r.vec_id] if d == r.deviation]
        assert options and r.n == n and abs(r.explained - share[r.component - 1]) < 1e-12 and r.identity_error < 1e-9
        s = sign.setdefault(r.component, np.sign(r.whitened) * np.sign(options[0]))
        assert min(abs(r.whitened * s - o) for o in options) < 1e-9


def test_whitening_of_flat_and_odd_tables(spark):
    flat = whiten(_df(spark, [[1, [1.0, 2.0], "a"], [2, [1.0, 2.0], "a"], [None, [1.0, 2.0], None]])).collect()
    assert sorted((r.vec_id or 0, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in flat) == [
        (i, c, 1, 0, None, 0.0, None) for i in (0, 1, 2) for c in (1, 2)
    ]
    line = whiten(_df(spark, [[i, [float(i), 0.0, 1.0], "a"] for i in range(4)])).collect()
    assert {(r.component, r.whitened is None, r.explained > 0) for r in line} == {(1, False, True), (2, True, False), (3, True, False)}
    assert max(r.identity_error for r in line) < 1e-9
    large = whiten(_df(spark, [[i, [1e12 * i, 5.0], "a"] for i in range(9)])).collect()
    assert {r.deviation is None for r in large} == {True, False}
    with pytest.raises(ValueError, match="one length"):
        whiten(_df(spark, [[1, [1.0], "a"], [2, [1.0, 2.0], "a"]]))


@pytest.mark.parametrize("operator", [top_k, whiten, lambda df: compress(df)[0]])
def test_empty_tables(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).isEmpty()


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 9, 24),
        np.geomspace(1, 1e-9, 24),
        np.concatenate(([5.0, 5.0, 5.0 + 1e-9, 5.0 - 1e-9], np.linspace(1, 4, 20))),
        np.concatenate(([2.0] * 6, [1.0 + k * 1e-11 for k in range(6)], np.linspace(0.1, 0.9, 12))),
        np.array([3.0] + [1.0] * 23),
        np.zeros(24),
    ],
)
def test_refinement_reaches_double_precision(values):
    rnd = np.random.default_rng(4)
    base = np.linalg.qr(rnd.normal(size=(24, 24)))[0]
    a = (base * values) @ base.T
    a = (a + a.T) / 2
    found, x = refined_eigenvectors(a)
    size = max(np.abs(a).max(), 1e-300)
    assert np.abs(x.T @ x - np.eye(24)).max() < 4e-16
    assert np.abs(np.linalg.norm(a @ x - x * found, axis=0)).max() < 2e-15 * size * 24
    assert np.abs(found - np.linalg.eigvalsh(a)[::-1]).max() < 1e-14 * size * 24
