"""Whitening against a dense eigendecomposition; exact deviations; edges."""

import math

import numpy as np
import pytest

from obsflow.llm import whitening
from obsflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, v string, whitened string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in vectors], SCHEMA).repartition(3)


def expected(vectors, components=8):
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    far = [sum(int(e) ** 2 for e in n * row - s) for row in x]
    c = (x - s / n).astype(float)
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    keep = np.flatnonzero(e > 1e-10 * max(e.sum(), 1e-300))[:components]
    return far, c @ u[:, keep] / np.sqrt(e[keep]), e[keep] / e.sum()


def compare(rows, keys, vectors, places=1e-7):
    far, want, shares = expected(vectors)
    assert len(rows) == want.size
    by = {(r.vec_id, r.component): r for r in rows}
    got = np.array([[by[k, c + 1].whitened for c in range(want.shape[1])] for k in keys])
    got = got * np.sign((got * want).sum(axis=0))
    assert np.abs(got - want).max() < places
    assert [int(by[k, 1].deviation) for k in keys] == far
    assert np.allclose([by[keys[0], c + 1].explained for c in range(len(shares))], shares, rtol=1e-9)
    assert {r.n for r in rows} == {len(keys)} and rows[0].identity_error < 1e-9


def test_equals_the_dense_solution(spark):
    chance = np.random.default_rng(5)
    vectors = (chance.standard_normal((200, 12)) * np.linspace(1, 3, 12)).astype(np.float32).tolist()
    compare(whitening.whiten(frame(spark, enumerate(vectors))).collect(), list(range(200)), vectors)


def test_low_rank_and_copies(spark):
    chance = np.random.default_rng(6)
    vectors = chance.integers(-50, 50, (60, 3)) @ chance.integers(-9, 9, (3, 10)) / 64
    vectors = np.vstack([vectors, np.repeat(vectors[:1], 40, axis=0)]).tolist()
    rows = whitening.whiten(frame(spark, enumerate(vectors))).collect()
    assert {r.component for r in rows} == {1, 2, 3}
    compare(rows, list(range(100)), vectors)


def test_equal_variances_are_all_found():
    """Every axis has the same variance: one start alone would find one component."""
    x = np.vstack([np.eye(6), -np.eye(6)]) * 100

    def step(q, w):
        t = x @ q
        return x.T @ t, float(t @ t), (x @ w).T @ t

    right, small = whitening.bidiagonalise(step, 6, float((x * x).sum()))
    assert np.allclose(np.linalg.svd(small)[1], np.sqrt(2) * 100) and np.allclose(right.T @ right, np.eye(6))


def test_bidiagonal_form():
    x = np.random.default_rng(8).standard_normal((80, 9)) * np.logspace(0, -6, 9)

    def step(q, w):
        t = x @ q
        return x.T @ t, float(t @ t), (x @ w).T @ t

    right, small = whitening.bidiagonalise(step, 9, float((x * x).sum()))
    assert np.allclose(np.tril(small, -1), 0) and np.allclose(np.triu(small, 2), 0)
    assert np.allclose(np.linalg.svd(small)[1], np.linalg.svd(x)[1], rtol=1e-8)


def test_edges(spark):
    none = float("nan")
    good = [[0.5, 1.0, -2.0], [1.5, 0.25, 3.0], [0.0, 0.0, 0.0], [0.5, 1.0, -2.0]]
    bad = [None, [None, 1.0, 2.0], [none, 1.0, 2.0], [float("inf"), 0.0, 0.0], [], [1.0, 2.0]]
    rows = whitening.whiten(frame(spark, [*enumerate(good), *((10 + i, v) for i, v in enumerate(bad))])).collect()
    assert {r.vec_id for r in rows} == {0, 1, 2, 3}
    compare(rows, [0, 1, 2, 3], good)
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect() == []
    named = whitening.whiten(frame(spark, [(None, [1.0, 2.0]), (None, [2.0, 4.0]), (3, [0.0, 9.0])])).collect()
    assert sorted((r.vec_id is None, r.component) for r in named) == [(False, 1), (False, 2), (True, 1), (True, 1), (True, 2), (True, 2)]


def test_large_entries(spark):
    vectors = [[1e15, 0.0], [-3e15, 1.0], [2e15, 2.0]]
    rows = {r.vec_id: r for r in whitening.whiten(frame(spark, enumerate(vectors))).collect() if r.component == 1}
    assert [int(rows[i].deviation) for i in range(3)] == expected(vectors)[0]
    far = whitening.deviations(np.array([[1 << 60]]), 1 << 30, (0,))
    assert far == [None]


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    rows = QUERIES["op12_whitening"](spark, f"/root/testdata/{sf}").collect()
    data = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").orderBy("vec_id").collect()
    assert dict(zip(rows[0].__fields__, map(type, rows[0]), strict=True))["deviation"] is int
    compare(rows, [r.vec_id for r in data], [r.embedding for r in data])
