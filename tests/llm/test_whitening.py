"""Whitening against dense linear algebra on exact integers."""

from fractions import Fraction

import numpy as np
import pytest

from panelflow.llm import whitening
from panelflow.llm.queries import QUERIES
from panelflow.session import materialize


def brute(vectors, k=32):
    """x as integers, n, exact deviations, eigenvalues and vectors of the dense covariance."""
    x = [[int(np.floor(64.0 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n = len(x)
    sums = [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for v in x])
    values, base = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:k]
    return n, deviation, centred, values[order], base[:, order], float(np.trace(centred.T @ centred / n))


def check(rows, vectors, ids, k=32):
    n, deviation, centred, values, base, trace = brute(vectors, k)
    k = len(values)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert set(got) == set(ids) and all(sorted(c) == list(range(1, k + 1)) for c in got.values())
    white = np.array([[got[i][j].whitened for j in range(1, k + 1)] for i in ids])
    assert all(got[i][1].deviation == d and got[i][1].n == n for i, d in zip(ids, deviation))
    assert np.allclose([got[ids[0]][j].explained for j in range(1, k + 1)], values / trace, rtol=1e-12)
    error = np.abs(white.T @ white / n - np.eye(k)).max()
    assert error < 1e-9 and {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-9
    want = centred @ base / np.sqrt(values)
    want *= np.sign((want * white).sum(axis=0))
    assert np.abs(white - want).max() < 1e-8


def test_query_on_the_given_table(spark, sf):
    rows = QUERIES["op13_embedding_whitening"](spark, sf).collect()
    table = [r for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect() if r.embedding is not None and np.isfinite(r.embedding).all()]
    check(rows, [r.embedding for r in table], [r.vec_id for r in table])


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = [(rng.standard_normal(6) * [1, 2, 3, 4, 5, 6]).tolist() for _ in range(50)]
    bad = [None, [], [1.0] * 5 + [None], [float("nan")] + [1.0] * 5, [float("-inf")] * 6, [1e30] * 6, [1.0, 2.0]]
    rows = [(i, v, 1) for i, v in enumerate(good + bad)] + [(1000, good[0], 1), (None, good[1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int").repartition(5)
    got = whitening.whiten(df).collect()
    assert len(got) == 52 * 6 and got[0].n == 52
    known = [r for r in got if r.vec_id is not None]
    n, deviation, *_ = brute(good + [good[0], good[1]])
    assert {r.vec_id: r.deviation for r in known} == {**dict(enumerate(deviation[:50])), 1000: deviation[50]}
    assert {r.deviation for r in got if r.vec_id is None} == {deviation[1]}
    assert whitening.whiten(df.limit(0)).collect() == []
    same = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whitening.whiten(same).collect() == []


def test_large_entries_are_counted_exactly(spark):
    vectors = [[1e9, 2.0], [-1e9, 7.0], [3.5, -2e9], [1.0, 2.0**45]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    rows = materialize(whitening.usable_vectors(df, carry=["vec_id"]))
    fitted = whitening.fit_whitening(rows, 2)
    deviation = brute(vectors)[1]
    got = {r.vec_id: r.deviation for r in fitted.apply(rows).collect()}
    assert got == {i: d if d < 1 << 63 else None for i, d in enumerate(deviation)}


@pytest.mark.parametrize("d,k", [(1, 1), (5, 3), (40, 32), (64, 32), (120, 32), (300, 8)])
def test_eigenpairs_against_dense(d, k):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((3 * d, d)) * np.linspace(1, 4, d)
    v = a.T @ a / len(a)
    values, vectors, steps = whitening.leading_eigenpairs(lambda u: v @ u, d, k)
    want = np.linalg.eigvalsh(v)[::-1][:k]
    assert np.abs(values - want).max() < 1e-12 * want[0] and steps < 60
    assert np.abs(v @ vectors - vectors * values).max() < 1e-12 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12


@pytest.mark.parametrize("values", [[3.0] * 10 + [1.0] * 30, [1.0] * 40, [5.0, 1e-3] + [0.0] * 38, [10.0**-i for i in range(40)], [1 + 1e-9 * i for i in range(40)]])
def test_ties_gaps_and_missing_rank(values):
    d = len(values)
    base, _ = np.linalg.qr(np.random.default_rng(2).standard_normal((d, d)))
    v = (base * values) @ base.T
    got, vectors, _ = whitening.leading_eigenpairs(lambda u: v @ u, d, 6)
    assert np.abs(got - sorted(values, reverse=True)[:6]).max() < 1e-13 * max(values)
    assert np.abs(vectors.T @ vectors - np.eye(6)).max() < 1e-12


def test_corrections_solve_their_equations():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    b = rng.standard_normal((30, 4))
    b[:, 3] = 0
    x = whitening.minres(lambda t: a @ t, b, 1e-13, 200)
    assert np.abs(a @ x - b).max() < 1e-7 and not x[:, 3].any()


def test_components_without_variance_are_left_out(spark):
    rng = np.random.default_rng(0)
    flat = rng.standard_normal((60, 3)).round(2)
    vectors = np.concatenate([flat, np.ones((60, 2))], axis=1).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    assert {r.component for r in whitening.whiten(df).collect()} == {1, 2, 3}
