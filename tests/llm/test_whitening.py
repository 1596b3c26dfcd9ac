"""Whitening against a full eigendecomposition in numpy."""

import math

import numpy as np
import pytest

from hearthscore.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x int, id string, n int, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", 2, "b") for i, v in rows], SCHEMA)


def reference(vectors, k=32):
    x = np.floor(64 * vectors.astype(np.float32).astype(float)) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    c = x - total / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return n, ((n * x - total) ** 2).sum(axis=1), c @ axes / np.sqrt(values), values / np.trace(c.T @ c / n)


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((400, 40)) * np.linspace(0.5, 2, 40)
    vectors[:130] = vectors[0] + 0.05 * rng.standard_normal((130, 40))  # a third nearly equal
    bad = [(900, None), (901, []), (902, [1.0] * 39 + [math.nan]), (903, [math.inf] * 40), (904, [1.0] * 39 + [None]), (905, [1.0] * 39)]
    rows = [(i if i else None, v.tolist()) for i, v in enumerate(vectors)]
    out = whitening.whiten(frame(spark, rows + bad).repartition(7)).collect()
    n, deviation, white, explained = reference(vectors)
    assert len(out) == 400 * 32 and {r.n for r in out} == {n}
    got = np.full((400, 32), np.nan)
    for r in out:
        i = r.vec_id or 0
        got[i, r.component - 1] = r.whitened
        assert r.deviation == deviation[i]
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert 0 <= r.identity_error < 1e-8
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got * signs - white).max() < 1e-6
    assert np.abs(got.T @ got / n - np.eye(32)).max() < 1e-8


def test_rows_repeat_and_rank_is_low(spark):
    base = np.random.default_rng(2).standard_normal((3, 10))
    rows = [(i, base[i % 3].tolist()) for i in range(60)]
    out = whitening.whiten(frame(spark, rows)).collect()
    assert {r.component for r in out} == {1, 2} and len(out) == 120
    assert max(r.identity_error for r in out) < 1e-8


def test_without_variance_or_rows(spark):
    rows = [(i, [0.5, 0.25]) for i in range(5)]
    assert whitening.whiten(frame(spark, rows)).count() == 0
    assert whitening.whiten(frame(spark, rows[:1])).count() == 0
    empty = whitening.whiten(frame(spark, rows).limit(0))
    assert empty.count() == 0 and empty.columns[0] == "vec_id"


def test_equal_and_close_eigenvalues():
    rng = np.random.default_rng(3)
    axes = np.linalg.qr(rng.standard_normal((50, 50)))[0]
    for values in (
        np.r_[[5.0] * 12, [5.0 - 1e-7] * 2, np.linspace(4, 1, 36)],
        np.r_[1e6, np.linspace(2, 1.9, 49)],
        np.r_[np.ones(50)],
    ):
        v = (axes * values) @ axes.T
        v = (v + v.T) / 2
        cut = whitening.intervals(v, 32)
        assert sum(n for _, _, n in cut) >= 32
        for low, high, n in cut:
            assert n == ((values > low) & (values <= high)).sum() or len(set(values)) == 1
            found, vectors = whitening.feast(v, low, high, n)
            assert np.abs(v @ vectors - vectors * found).max() < 1e-9 * values.max()
            assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-9


def test_inertia_counts():
    rng = np.random.default_rng(8)
    for d in (1, 2, 3, 17):
        a = rng.standard_normal((d, d))
        a = a + a.T
        form, values = whitening.tridiagonal(a), np.linalg.eigvalsh(a)
        for shift in np.r_[values - 1e-6, values + 1e-6]:
            assert whitening.count_above(form, shift) == (values > shift).sum()


def test_exact_beyond_longs():
    dev = whitening.deviations(np.array([[2**40, 3]]), 2**30, [7, 8])
    assert dev.tolist() == [[2**70 - 7, 3 * 2**30 - 8]]
    assert whitening.squared(dev) == [None]
    assert whitening.squared(np.array([[2**31, 2**31]])) == [None]
    assert whitening.squared(np.array([[2**31, 2**30]])) == [2**62 + 2**60]
