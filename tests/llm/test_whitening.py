"""Whitening against numpy's eigenvectors of the plain covariance."""

import collections
import math

import numpy as np

from contiglink.llm import whitening


def test_pivots_count_eigenvalues():
    r = np.random.default_rng(3)
    for t in range(200):
        d = int(r.integers(1, 20))
        a = r.normal(size=(d, d))
        a = np.where(abs(a + a.T) < t % 3 / 2, 0, a + a.T)
        w = np.linalg.eigvalsh(a)
        assert abs(w).min() < 1e-9 or whitening.positive_pivots(a) == (w > 0).sum()


def test_leading_components():
    r = np.random.default_rng(4)
    for t in range(150):
        d, n = int(r.integers(1, 40)), int(r.integers(1, 90))
        x = np.floor(r.normal(size=(n, d)) * r.integers(1, 300, d))
        x = np.vstack([np.eye(d), -np.eye(d)]) * 100 if t % 4 == 0 else x  # all eigenvalues equal
        x = np.hstack([x, x]) if t % 5 == 0 else x  # half of the space is empty
        v = (x - x.mean(0)).T @ (x - x.mean(0)) / len(x)
        w = np.linalg.eigvalsh(v)[::-1]
        e, q = whitening.leading_components(v, 4)
        assert len(e) == min(4, (w > 1e-12 * w.sum()).sum())
        assert np.allclose(e, w[: len(e)], rtol=1e-11) and np.allclose(q @ q.T, np.eye(len(e)), atol=1e-10)
        assert not len(e) or abs(v @ q.T - q.T * e).max() < 1e-11 * w[0]


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, v, "x", 1.0) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, component string, n double")


def expected(rows, most=4):
    fit = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array(sorted({tuple(v) for _, v in fit}), float)
    n, s = len(x), x.sum(0)
    v = (x - s / n).T @ (x - s / n) / n
    w, q = np.linalg.eigh(v)
    out = collections.defaultdict(list)
    for i, u in fit:
        for k in range(1, min(most, (w > 1e-12 * w.sum()).sum()) + 1):
            out[i].append((k, n, sum((n * a - int(b)) ** 2 for a, b in zip(u, s)), float((np.array(u) - s / n) @ q[:, -k] / math.sqrt(w[-k])), w[-k] / w.sum(), q[:, -k]))
    return out


def test_operator(spark):
    r = np.random.default_rng(7)
    vectors = [[float(c) for c in v] for v in r.normal(size=(300, 6)) * [3, 2, 1, 0.5, 0.1, 4]]
    vectors += [vectors[0]] * 100 + [None, [], [None] * 6, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0], [float("inf")] * 6, [1.0, 2.0], [0.0] * 6, [-0.0] * 6]
    ids = [None if k == 5 else k for k in range(len(vectors))]
    got = whitening.whiten(table(spark, vectors, ids)).collect()
    want = expected([(i, v) for i, v in zip(ids, vectors) if v is None or len(v) != 2])
    assert len(got) == sum(map(len, want.values()))
    turn = {}
    for g in got:
        k, n, deviation, whitened, explained, _ = next(x for x in want[g.vec_id] if x[0] == g.component)
        assert (g.n, g.deviation) == (n, deviation) and math.isclose(g.explained, explained, rel_tol=1e-10)
        if abs(whitened) > 1e-6:
            assert turn.setdefault(k, math.copysign(1, g.whitened / whitened)) == math.copysign(1, g.whitened / whitened)
        assert math.isclose(abs(g.whitened), abs(whitened), rel_tol=1e-8, abs_tol=1e-8) and g.identity_error < 1e-9


def test_odd_tables(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [None, [], [None]])).count() == 0
    assert whitening.whiten(table(spark, [[1.0, 2.0]] * 5)).count() == 0  # no variance
    assert whitening.whiten(table(spark, [[1.0, 2.0], [3.0, 4.0]])).count() == 2  # one component
    wide = whitening.whiten(table(spark, [[1e30, 0.0], [-1e30, 1.0], [0.0, 2.0]])).collect()
    assert {x.deviation is None for x in wide} == {True} or any(x.deviation is None for x in wide)
    big = whitening.whiten(table(spark, [[1e5, 0.0], [0.0, 1.0], [5.0, 2.0]])).collect()
    want = expected([(0, [1e5, 0.0]), (1, [0.0, 1.0]), (2, [5.0, 2.0])])
    assert all(x.deviation == want[x.vec_id][0][2] for x in big)
