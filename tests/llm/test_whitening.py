"""Whitening against a dense eigendecomposition."""

import math

import numpy as np
import pytest

from tamis.llm import queries, whitening

ROWS = "vec_id long, embedding array<double>, x string, n int"


def plain(vectors, components=32):
    x = np.floor(64 * np.asarray(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    y = x - sums / n
    values, columns = np.linalg.eigh(y.T @ y / n)
    values, columns = values[::-1], columns[:, ::-1]
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    many = min(components, x.shape[1])
    return deviation, values, y @ columns[:, :many] / np.sqrt(np.maximum(values[:many], 1e-300))


def check(rows, ids, vectors, close=1e-7):
    deviation, values, expected = plain(vectors)
    got = {(r.vec_id, r.component): r for r in rows}
    many = max(r.component for r in rows)
    assert len(got) == len(rows) == len(ids) * many
    found = np.array([[got[i, k].whitened for k in range(1, many + 1)] for i in ids])
    signs = np.sign((found * expected[:, :many]).sum(axis=0))
    assert np.abs(found - expected[:, :many] * signs).max() < close
    assert [got[i, 1].deviation for i in ids] == deviation and {r.n for r in rows} == {len(ids)}
    share = np.array([got[ids[0], k].explained for k in range(1, many + 1)])
    assert np.abs(share / (values[:many] / values.sum()) - 1).max() < 1e-6
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-4
    return many


def test_query_matches_eigenvectors(spark, small):
    data = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    rows = queries.op11_whitening(spark, small).collect()
    assert check(rows, [r.vec_id for r in data], [r.embedding for r in data]) == 32


def test_bidiagonalisation_finds_equal_and_missing_values():
    rng = np.random.RandomState(3)
    basis = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    for sigma in ([9, 9, 9, 4, 4, 1, 0, 0, 0, 0, 0, 0], [5] * 12, [1e3, 1, 1, 1e-2] + [1e-3] * 8, [3] + [0] * 11):
        gram = basis @ np.diag(np.square(np.array(sigma, float))) @ basis.T
        got, vectors, steps = whitening.bidiagonalise(lambda v: gram @ v, 12, float(np.trace(gram)), 5)  # noqa: B023
        assert np.allclose(got, sorted(sigma, reverse=True)[:5], rtol=1e-6, atol=1e-6 * max(sigma)) and steps <= 12
        assert np.allclose(vectors @ vectors.T, np.eye(5), atol=1e-10)
        assert np.allclose(gram @ vectors.T, vectors.T * np.square(got), atol=1e-9 * max(sigma) ** 2)


def test_few_steps_when_the_rest_is_small():
    rng = np.random.RandomState(4)
    basis = np.linalg.qr(rng.standard_normal((200, 200)))[0]
    gram = (basis * np.square(0.5 ** np.arange(200))) @ basis.T
    assert whitening.bidiagonalise(lambda v: gram @ v, 200, float(np.trace(gram)), 4)[2] < 60


@pytest.mark.parametrize("n", [2, 5, 40])
def test_fewer_rows_than_dimensions(spark, n):
    rng = np.random.RandomState(n)
    vectors = rng.standard_normal((n, 10)).tolist()
    rows = whitening.whiten(spark.createDataFrame([(i, v, "x", 1) for i, v in enumerate(vectors)], ROWS), 6).collect()
    assert check(rows, list(range(n)), vectors) == min(6, n - 1)


def test_odd_rows(spark):
    rng = np.random.RandomState(9)
    good = [(i, rng.standard_normal(4).tolist()) for i in range(8)]
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0, 3.0]), (93, [math.nan, 0.0, 0.0, 0.0]), (94, [math.inf, 0.0, 0.0, 0.0]),
           (95, [1.0, 2.0]), (96, [-1e300, 0.0, 0.0, 0.0])]
    rows = whitening.whiten(spark.createDataFrame([(*r, "x", 1) for r in [*bad, *good]], ROWS)).collect()
    assert check(rows, [i for i, _ in good], [v for _, v in good]) == 4
    twice = [*good, good[0], (None, good[1][1])]
    rows = whitening.whiten(spark.createDataFrame([(*r, "x", 1) for r in twice], ROWS)).collect()
    assert len(rows) == 40 and {r.n for r in rows} == {10}
    same = [(i, [1.0, 2.0]) for i in range(3)]
    for few in ([], bad[:5], same, good[:1]):
        assert whitening.whiten(spark.createDataFrame([(*r, "x", 1) for r in few], ROWS)).collect() == []


def test_deviations_are_exact_or_null():
    x = np.array([[1 << 36, 1_000_000], [1_000_000, 1_000_001], [-5, 7]])
    sums = [int(s) for s in x.sum(axis=0)]
    exact = [sum((3 * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    assert whitening.deviations(x, 3, sums) == [e if e < 1 << 63 else None for e in exact]
    x = np.array([[1_000_000, 999_990], [1_000_005, 1_000_001]])
    assert whitening.deviations(x, 2, [2_000_005, 1_999_991]) == [25 + 121, 25 + 121]
