"""Whitening against a dense eigensolver, over tables with odd rows."""

import numpy as np
import pytest

from panelspark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n long, component string, whitened double"
BAD = [None, [None, 1.0], [float("nan"), 1.0], [float("inf"), 0.0], [1.0, float("-inf")]]


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 7, "c", 0.5) for i, v in zip(ids, vectors, strict=True)], SCHEMA).repartition(3)


def dense(vectors, components):
    """Whole vectors, their distinct ones' mean and covariance by a dense solver."""
    width = max(map(len, vectors))
    x = np.array([[int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in [*v, *[0.0] * (width - len(v))]] for v in vectors])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    values, vectors_ = values[::-1][:components], vectors_[:, ::-1][:, :components]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return n, deviation, (x - sums / n) @ vectors_ / np.sqrt(values), values / np.trace(centred.T @ centred / n), values


def check(spark, vectors, components, bad=BAD):
    df = frame(spark, [*vectors, *bad])
    model = whitening.fit(df, components)
    rows = sorted(whitening.whiten(df, model).collect(), key=lambda r: (r.vec_id, r.component))
    n, deviation, want, explained, values = dense(vectors, components)
    k = len(model.values)
    assert [(r.vec_id, r.component) for r in rows] == [(i, c) for i in range(len(vectors)) for c in range(1, k + 1)]
    got = np.array([r.whitened for r in rows]).reshape(len(vectors), k)
    assert np.allclose(np.abs(got), np.abs(want[:, :k]), atol=1e-6)
    assert {r.n for r in rows} == {n} and [r.deviation for r in rows[::k]] == deviation
    assert np.allclose([r.explained for r in rows[:k]], explained[:k], rtol=1e-9)
    assert max(r.identity_error for r in rows) < 1e-9
    return model


def test_equals_dense_solver(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.standard_normal((300, 40)) * np.linspace(3, 0.5, 40)).astype(np.float32).tolist()
    model = check(spark, vectors + vectors[:50] + [vectors[0]] * 150, 5)
    assert model.n == 300 and model.passes > 1 and model.residual < 1e-11


def test_close_eigenvalues_and_short_vectors(spark):
    rng = np.random.default_rng(6)
    vectors = rng.standard_normal((200, 24)).astype(np.float32).tolist()
    check(spark, [*vectors, [], [1.0], vectors[3][:10]], 4)


def test_rank_below_components(spark):
    rng = np.random.default_rng(7)
    vectors = np.round(rng.standard_normal((6, 30)) * 4).tolist()
    assert len(check(spark, vectors, 16).values) == 5


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [[], []]])
def test_nothing_to_whiten(spark, vectors):
    df = frame(spark, vectors)
    assert whitening.whiten(df, whitening.fit(df)).collect() == []


def test_ids_and_long_sums(spark):
    vectors = [[1e14, 0.0], [-1e14, 0.25], [5.0, 1.0], [5.0, 1.0]]
    df = frame(spark, vectors, [None, 4, 4, 4])
    rows = whitening.whiten(df, whitening.fit(df, 1)).collect()
    assert sorted(str(r.vec_id) for r in rows) == ["4", "4", "4", "None"]
    assert {r.deviation for r in rows if r.vec_id is None} == {None}  # beyond 64 bits


def test_bounded_partial_sums(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "BLOCK", 8)
    rng = np.random.default_rng(8)
    check(spark, rng.standard_normal((120, 12)).astype(np.float32).tolist(), 2)
