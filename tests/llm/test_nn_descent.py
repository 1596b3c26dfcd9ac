"""NN-descent against all pairs."""

import numpy as np
import pytest

from hearthscore.llm import nn_descent

SCHEMA = "vec_id long, embedding array<float>, node long, key string, n_links int, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "k", 3, 4) for i, v in rows], SCHEMA).repartition(5)


def brute_force(vectors):
    x = np.asarray(vectors, dtype=np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    root = np.arange(len(x))
    while True:
        low = np.array([min(root[i], root[linked[i]].min(initial=root[i])) for i in range(len(x))])
        if (low == root).all():
            return linked.sum(axis=1), root
        root = low


def check(spark, vectors, settings=nn_descent.Settings()):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    out = nn_descent.near_duplicates(frame(spark, rows), settings=settings).collect()
    degree, root = brute_force(vectors)
    got = {r.vec_id: r for r in out}
    assert len(out) == len(vectors)
    for i in range(len(vectors)):
        assert (got[i].n_links, got[i].component_id) == (degree[i], root[i]), i
        assert got[i].kept == (root[i] == i) and got[i].audited_recall >= 0.98
    return degree


def near(rng, base, n, spread):
    return base + spread * rng.standard_normal((n, len(base))) / np.sqrt(len(base))


def test_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    vectors = [rng.standard_normal((600, 24))]
    for i in range(0, 120, 2):
        vectors.append(near(rng, vectors[0][i], rng.integers(1, 5), 0.9))  # cosines around the threshold
    vectors.append(near(rng, vectors[0][200], 300, 1.0))  # a third of the rows in one group
    vectors.append(np.repeat(vectors[0][300:301], 80, axis=0))  # copies
    degree = check(spark, np.vstack(vectors)[rng.permutation(sum(map(len, vectors)))])
    assert degree.max() >= 250 and (degree == 1).any()


def test_two_groups_that_link_across_and_a_chain(spark):
    rng = np.random.default_rng(2)
    a, b = np.eye(16)[0], np.eye(16)[1]
    turned = np.cos(np.radians(18)) * a + np.sin(np.radians(18)) * b
    groups = [near(rng, a, 120, 0.05), near(rng, turned, 120, 0.05)]
    angles = np.radians(np.arange(60, 150, 0.5))  # a chain no ball holds
    chain = np.outer(np.cos(angles), np.eye(16)[2]) + np.outer(np.sin(angles), np.eye(16)[3])
    small = nn_descent.Settings(list_size=6, enlarged=16, met=16, block=50)
    check(spark, np.vstack([*groups, chain, rng.standard_normal((100, 16))]), small)


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, float("nan"), 2.0]), (5, [1.0, None, 2.0]),
        (6, [float("inf"), 1.0, 2.0]), (7, v), (7, v), (None, v), (8, [2.0, 4.0, 6.0]), (9, [1.0, 2.0]),
        (10, [-1.0, -2.0, -3.0]), (None, [9.0, -5.0, 0.0]), (11, [1e-30, 2e-30, 3e-30]),
    ]
    out = nn_descent.near_duplicates(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    alone = [r for r in out if r.vec_id in (1, 2, 3, 4, 5, 6, 9, 10)]
    assert all((r.n_links, r.component_id, r.kept) == (0, r.vec_id, True) for r in alone)
    linked = [r for r in out if r.component_id == 7]
    assert len(linked) == 5 and {r.n_links for r in linked} == {4}
    assert sorted(r.vec_id for r in linked if r.kept) == [7, 7]
    assert nn_descent.near_duplicates(frame(spark, rows).limit(0)).count() == 0
    assert nn_descent.near_duplicates(frame(spark, rows[:3])).count() == 3


def test_pairs_at_the_threshold_are_decided_in_doubles(spark):
    base = np.eye(8)[0]
    rows = []
    for k, cosine in enumerate((0.9 + 1e-5, 0.9 - 1e-5)):
        other = np.zeros(8)
        other[0], other[k + 1] = cosine, np.sqrt(1 - cosine**2)
        rows.append(other)
    degree, _ = brute_force([base, *rows])
    assert degree.tolist() == pytest.approx([1, 1, 0])
    check(spark, np.vstack([base, *rows]))
