"""Binned forests against a plain search, and against Spark's model of the same trees."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from hearthscore.config import ForestSettings
from hearthscore.operators import forest as fo

S = ForestSettings(trees=3, depth=4, min_rows=10, columns="sqrt")
N = 900


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(N, 5))
    x[:, 1] = rng.integers(0, 3, N)
    x[:, 3] = 7.0  # constant
    z = x[:, 0] + x[:, 1] * x[:, 2]
    return x, (z + rng.normal(size=N) > 1).astype(float), z * 10, np.where(np.arange(N) % 3 == 0, 2.0, 1.0)


@pytest.fixture(scope="module")
def tables(spark, data):
    rows = [(i, [float(v) for v in r], float(a), float(b), float(w)) for i, (r, a, b, w) in enumerate(zip(*data))]
    df = spark.createDataFrame(rows, "k long, x array<double>, y double, cost double, weight double")
    return df.withColumn("features", array_to_vector("x")).repartition(5).persist()


def drawn(tables, tree):
    u = dict(tables.select("k", F.xxhash64("k")).collect())
    return fo._times(np.array([u[i] for i in range(N)]), 1 + 104729 * (tree + 1))


@pytest.mark.parametrize("classify", [True, False])
@pytest.mark.parametrize("group", [fo.GROUP_BYTES, 1])
def test_every_node_has_the_best_split_of_its_columns(spark, data, tables, classify, group, monkeypatch):
    monkeypatch.setattr(fo, "GROUP_BYTES", group)
    x, flag, cost, w = data
    y = flag if classify else cost
    df = tables.withColumn("label", F.col("y" if classify else "cost"))
    df = df if classify else df.drop("weight")
    w = w if classify else np.ones(N)
    other, model = fo.fit_forests([df.filter("k < 300"), df], "k", S, 1, classify)
    assert (other.column >= 0).any()
    bins = np.array([len(e) + 1 for e in model.edges])
    for tree in range(S.trees):
        n = drawn(tables, tree)
        rows = {0: np.arange(N)}
        for at in range(2**S.depth - 1):
            if at not in rows:
                continue
            r = rows[at]
            level = (at + 1).bit_length() - 1
            layout = fo.Layout.of(np.array([at]), bins, S.columns, (1, tree, level))
            best = (1e-9, None)
            for c in layout.columns[0]:
                for j, edge in enumerate(model.edges[c]):
                    parts = [r[x[r, c] <= edge], r[x[r, c] > edge]]
                    if min(n[p].sum() for p in parts) < S.min_rows:
                        continue
                    nw = n * w
                    gain = sum((nw[p] @ y[p]) ** 2 / nw[p].sum() for p in parts) - (nw[r] @ y[r]) ** 2 / nw[r].sum()
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, c, j, parts)
            if best[1] is None:
                assert model.column[tree, at] == -1
                continue
            assert (model.column[tree, at], model.cut[tree, at]) == best[1:3]
            assert model.gain[tree, at] == pytest.approx(best[0])
            rows[2 * at + 1], rows[2 * at + 2] = best[3]
        for at, r in rows.items():
            nw = (n * w)[r]
            assert model.sums[tree, at, :3] == pytest.approx([n[r].sum(), nw.sum(), nw @ y[r]])


def test_draws_are_poisson_numbers():
    n = fo._times(np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 200_000), 9)
    assert n.mean() == pytest.approx(1, abs=0.02) and n.var() == pytest.approx(1, abs=0.03)
    assert (n == 0).mean() == pytest.approx(np.exp(-1), abs=0.005)


@pytest.mark.parametrize("classify", [True, False])
def test_sparks_model_scores_like_the_trees(spark, data, tables, classify, tmp_path):
    x = data[0]
    df = tables.withColumn("label", F.col("y" if classify else "cost"))
    model = fo.fit_forests([df], "k", S, 1, classify)[0]
    made = fo.to_spark(spark, model, S, 1, classify)
    made.save(f"file://{tmp_path}/kept")
    made = type(made).load(f"file://{tmp_path}/kept")
    want = np.zeros(N)
    for tree in range(S.trees):
        for i in range(N):
            at = 0
            while model.column[tree, at] >= 0:
                c = model.column[tree, at]
                at = 2 * at + 1 + int(x[i, c] > model.edges[c][model.cut[tree, at]])
            want[i] += model.sums[tree, at, 2] / model.sums[tree, at, 1] / S.trees
    out = made.transform(df).select("k", (vector_to_array("probability")[1] if classify else F.col("prediction")).alias("p"))
    got = dict(out.collect())
    assert [got[i] for i in range(N)] == pytest.approx(want)
    assert made.getNumTrees == S.trees and made.featureImportances.toArray().sum() == pytest.approx(1)


def test_a_table_without_rows_scores(spark, tables):
    df = tables.withColumn("label", F.col("y")).filter("k < 0")
    assert (fo.fit_forests([df], "k", S, 1, True)[0].column == -1).all()
    assert fo.fit_forests([], "k", S, 1, True) == []


@pytest.mark.parametrize("weighted", [True, False])
def test_sums_of_all_columns_are_those_of_drawn_ones(weighted):
    rng = np.random.default_rng(2)
    bins = np.array([4, 9, 1, 30])
    w = rng.random(N) + 0.5 if weighted else np.ones(N)
    lines = (rng.integers(0, 30, (4, N)) % bins[:, None]).astype(np.uint8)
    b = fo.Block(0, rng.random(N), w, rng.integers(0, 2**62, N), np.zeros(N), lines)
    column, cut = np.array([1, 3, -1, -1, -1, -1, -1]), np.array([4, 11, 0, 0, 0, 0, 0])
    layout = fo.Layout.of(np.array([3, 4]), bins, "all", (1, 2, 2))
    drawn = fo.Layout.of(np.array([3, 4]), bins, "1.0", (1, 2, 2))
    assert layout.whole and not drawn.whole
    cells = np.ascontiguousarray(lines.T).ravel()
    for plain in (True, False):
        got, want = (fo._sums(b, cells, (column, cut), x, 2, 7, plain) for x in (layout, drawn))
        assert np.array_equal(got, want) and want.any()


def test_nodes_reach_spark_as_columns_not_as_rows(spark, tables, monkeypatch):
    df = tables.withColumn("label", F.col("y"))
    model = fo.fit_forests([df], "k", S, 1, True)[0]
    rows = fo._nodes(model, True).to_pylist()
    for tree in range(S.trees):
        mine = {r["nodeData"]["id"]: r["nodeData"] for r in rows if r["treeID"] == tree}
        assert sorted(mine) == list(range(len(mine)))
        open_nodes = [(0, 0)]
        for at, i in open_nodes:
            node, c = mine.pop(i), model.column[tree, at]
            w, wy = model.sums[tree, at, 1:3]
            assert node["impurityStats"] == [w - wy, wy] and node["prediction"] == float(wy / w > 0.5)
            assert node["split"]["featureIndex"] == c and (node["leftChild"] < 0) == (c < 0)
            if c >= 0:
                assert node["split"]["leftCategoriesOrThreshold"] == [model.edges[c][model.cut[tree, at]]]
                assert node["gain"] == model.gain[tree, at] / w * 2
                open_nodes += [(2 * at + 1, node["leftChild"]), (2 * at + 2, node["rightChild"])]
        assert not mine
    seen, made = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **k: seen.append(data) or made(self, data, *a, **k))
    fo.to_spark(spark, model, S, 1, True)
    assert max(len(d) for d in seen if isinstance(d, list)) <= S.trees
