import math

import numpy as np
import pytest

from topiclens.llm import whitening
from topiclens.llm.queries import QUERIES


def reference(rows):
    """Covariance, eigenvalues and whitened rows with a library's solver."""
    x = np.array(rows, np.float64)
    fit = np.unique(x, axis=0)
    mean = fit.mean(axis=0)
    v = np.cov(fit.T, bias=True).reshape(x.shape[1], x.shape[1])
    e, w = np.linalg.eigh(v)
    order = np.argsort(-e)
    return len(fit), e[order], w[:, order], (x - mean) @ w[:, order] / np.sqrt(np.maximum(e[order], 1e-300)), np.trace(v)


def table(spark, rows, parts=3):
    names = "component n x deviation whitened size count id".split()
    schema = "vec_id long, embedding array<double>, " + ", ".join(f"{c} string" for c in names)
    return spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], schema).repartition(parts)


def check(found, vectors, k=4, tolerance=1e-9):
    whole = {i: [math.floor(256 * c) for c in v] for i, v in vectors}
    ids = list(whole)
    n, e, _, w, trace = reference([whole[i] for i in ids])
    parts = min(k, len(e))
    got = {(r.vec_id, r.component): r for r in found}
    assert set(got) == {(i, c) for i in ids for c in range(1, parts + 1)}
    sums = [sum(c) for c in zip(*{tuple(v) for v in whole.values()})]
    for c in range(parts):
        mine = np.array([got[i, c + 1].whitened for i in ids])
        sign = np.sign(mine @ w[:, c])
        assert np.abs(mine - sign * w[:, c]).max() < tolerance
    for r in found:
        assert r.n == n and r.identity_error < 1e-4
        assert r.deviation == sum((n * x - s) ** 2 for x, s in zip(whole[r.vec_id], sums))
        assert abs(r.explained - e[r.component - 1] / trace) < 1e-9


def sample(seed, n, size, far=0.0):
    r = np.random.default_rng(seed)
    return [(i, (far + r.normal(size=size) * np.linspace(3, 0.5, size)).tolist()) for i in range(n)]


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_against_a_library(spark, size):
    vectors = sample(size, 300, size)
    vectors += [(1000 + i, v) for i, v in vectors[:80]]  # repeated vectors count once
    check(whitening.whitened(table(spark, vectors)).collect(), vectors)


def test_far_from_the_origin(spark):
    # Products that are not centred would lose all digits.
    vectors = sample(3, 200, 5, far=2.0**33)
    check(whitening.whitened(table(spark, vectors)).collect(), vectors, tolerance=1e-6)


def test_same_whatever_the_parts(spark):
    vectors = sample(4, 500, 6)
    a, b = (sorted(map(tuple, whitening.whitened(table(spark, vectors, p)).collect())) for p in (1, 7))
    assert [r[:3] + r[4:6] for r in a] == [r[:3] + r[4:6] for r in b]


def test_edges(spark):
    vectors = sample(5, 40, 3)
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 0.0]), (104, [1.0, 2.0]),
           (105, [float("inf"), 0.0, 0.0]), (106, [-float("inf"), 0.0, 0.0])]
    found = whitening.whitened(table(spark, vectors + odd)).collect()
    check(found, vectors)
    assert whitening.whitened(table(spark, [])).collect() == []
    assert whitening.whitened(table(spark, odd[:1])).collect() == []
    assert whitening.whitened(table(spark, [(i, [0.5, 0.5]) for i in range(9)])).collect() == []
    none = whitening.whitened(table(spark, [(None, [1.0, 2.0]), (None, [3.0, 5.0])])).collect()
    assert len(none) == 2 and none[0].vec_id is None
    # One direction has no variance: it is no component.
    flat = [(i, [float(i), 2.0]) for i in range(9)]
    assert {r.component for r in whitening.whitened(table(spark, flat)).collect()} == {1}


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(1, [1e15, 0.0]), (2, [-1e15, 3.0]), (3, [1e300, 1.0])]
    found = whitening.whitened(table(spark, rows)).collect()
    assert found and all(r.deviation is None for r in found)


def matrices():
    r = np.random.default_rng(1)
    yield np.diag([3.0, 3.0, 3.0, 1.0, 1.0])
    yield np.eye(6)
    yield np.zeros((4, 4))
    yield np.array([[2.0]])
    q, _ = np.linalg.qr(r.normal(size=(40, 40)))
    yield q @ np.diag([5, 5, 5 - 1e-13, 4, *np.linspace(1, 0, 36)]) @ q.T
    yield q @ np.diag([1e8, 1, 1e-3, *[0.0] * 37]) @ q.T
    for n in (2, 3, 10, 64):
        a = r.normal(size=(n, n))
        yield a @ a.T
        yield a + a.T
    yield 1e-200 * (lambda a: a @ a.T)(r.normal(size=(5, 5)))


def test_eigenvectors_against_a_library():
    for m in matrices():
        m = (m + m.T) / 2
        values, vectors = whitening.eigenvectors(m, 4)
        e = np.sort(np.linalg.eigvalsh(m))[::-1][: len(values)]
        large = np.abs(m).max() or 1.0
        assert np.abs(values - e).max(initial=0) < 1e-13 * large * len(m)
        assert np.abs(vectors @ vectors.T - np.eye(len(values))).max(initial=0) < 1e-14 * len(m)
        assert np.abs(m @ vectors.T - vectors.T * values).max(initial=0) < 2e-14 * large * len(m)


def test_query(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()
    check(QUERIES["op11_householder"](spark, small).collect(), [tuple(r) for r in rows])
