import math

import numpy as np
import pytest

from cohortair.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n string"


def brute(vectors):
    x = np.array([np.floor(64 * np.array(v, dtype=np.float32).astype(float)) + 1_000_000 for v in vectors])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    v = np.cov(fit.T, bias=True)
    e, u = np.linalg.eigh(v)
    return x, n, s, e[::-1], u[:, ::-1], np.trace(v)


def test_whitening_equals_eigh_and_keeps_repeats(spark):
    rng = np.random.default_rng(3)
    vectors = [list(map(float, rng.normal(0, 0.2, 6) * (1 + np.arange(6)))) for _ in range(40)]
    rows = [(i, v, "x") for i, v in enumerate(vectors)] + [(100, vectors[0], "copy"), (101, vectors[0], "copy")]
    rows += [(200, None, "null"), (201, [0.1, None, 0.2, 0.1, 0.1, 0.1], "hole"), (202, [math.nan] * 6, "nan"),
             (203, [math.inf, 0.0, 0.0, 0.0, 0.0, 0.0], "inf"), (204, [0.1, 0.2], "short"), (None, vectors[1], "no id")]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA), components=4).collect()
    kept = vectors + [vectors[0], vectors[0], vectors[1]]
    x, n, s, e, u, trace = brute(kept)
    assert {r.vec_id for r in got} == set(range(40)) | {100, 101, None}
    assert len(got) == 43 * 4 and all(r.n == n == 40 for r in got)
    ids = [*range(40), 100, 101, None]
    for r in got:
        row = x[ids.index(r.vec_id)]
        assert r.deviation == int(((n * row - s) ** 2).sum())
        k = r.component - 1
        assert abs(abs(r.whitened) - abs((row - s / n) @ u[:, k] / math.sqrt(e[k]))) < 1e-9
        assert abs(r.explained - e[k] / trace) < 1e-9
        assert r.identity_error < 1e-9
    # one sign for all rows of a component
    first = {r.component: np.sign(r.whitened) for r in got if r.vec_id == 0}
    same = {r.component: np.sign(r.whitened) for r in got if r.vec_id == 100}
    assert first == same


def test_equal_eigenvalues_get_an_orthonormal_basis():
    a = np.diag([3.0, 3.0, 1.0, 0.5])
    q, _ = np.linalg.qr(np.random.default_rng(0).normal(size=(4, 4)))
    m = q @ a @ q.T
    values, vectors = whitening.leading_eigenpairs(m, 4)
    assert np.allclose(values, [3, 3, 1, 0.5])
    assert np.allclose(vectors.T @ vectors, np.eye(4), atol=1e-12)
    assert np.allclose(m @ vectors, vectors * values, atol=1e-12)


def test_counts_number_the_values():
    m = np.array([[2.0, 1.0, 0.0], [1.0, 2.0, 1.0], [0.0, 1.0, 2.0]])
    diag, off = whitening.tridiagonal(m)
    assert [whitening.tridiagonal_inertia(diag, off, s, 1e-15) for s in (0.5, 1.0, 2.5, 3.5)] == [0, 1, 2, 3]


@pytest.mark.parametrize("rows", [[], [(1, None, "x")], [(1, [0.5, 0.5], "x"), (2, [0.5, 0.5], "x")]])
def test_empty_and_constant_tables(spark, rows):
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA), components=2).collect()
    if len(rows) == 2:  # one distinct vector: no spread, whitened and explained null
        assert len(got) == 4 and all(r.whitened is None and r.explained is None and r.deviation == 0 for r in got)
    else:
        assert got == []
