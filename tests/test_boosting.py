"""Binned boosting against a plain Python version and against Spark's own."""

import gc

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from hearthscore.config import BoostSettings
from hearthscore.operators import boosting as bo

PLAIN = BoostSettings(rounds=4, depth=3, step=0.3, row_share=1.0, column_share="all", min_rows=5)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 4))
    x[:, 1] = rng.integers(0, 3, 500)
    x[:, 3] = 7.0  # constant
    z = 2 * x[:, 0] + x[:, 1] * x[:, 2]
    return x, (z + rng.normal(size=500) > 1).astype(float), z * 10


@pytest.fixture(scope="module")
def tables(spark, data):
    x, y, cost = data
    rows = [(i, [float(v) for v in r], float(a), float(b)) for i, (r, a, b) in enumerate(zip(x, y, cost))]
    df = spark.createDataFrame(rows, "k long, x array<double>, y double, cost double")
    return df.withColumn("features", array_to_vector("x")).repartition(5).persist()


def plain(x, y, w, s, edges, logistic):
    """Exhaustive search over all columns and cuts, one row set per node."""
    ridge = 1.0 if logistic else 0.0
    mean = (w @ y) / w.sum()
    margin = np.full(len(y), np.log(mean / (1 - mean)) if logistic else mean)
    for _ in range(s.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = (w * (p - y), w * p * (1 - p)) if logistic else (w * (margin - y), w)
        add = np.zeros(len(y))

        def grow(rows, depth):
            best = (1e-12, None)
            whole = g[rows].sum() ** 2 / (h[rows].sum() + ridge)
            for c, cuts in enumerate(edges) if depth < s.depth else ():
                for cut in cuts:
                    left = x[rows, c] <= cut
                    a, b = rows[left], rows[~left]
                    if h[a].sum() < s.min_rows or h[b].sum() < s.min_rows:
                        continue
                    gain = sum(g[i].sum() ** 2 / (h[i].sum() + ridge) for i in (a, b)) - whole
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, (a, b))
            if best[1] is None:
                add[rows] = -g[rows].sum() / (h[rows].sum() + ridge)
            else:
                for part in best[1]:
                    grow(part, depth + 1)

        grow(np.arange(len(y)), 0)
        margin = margin + s.step * add
    return margin


@pytest.mark.parametrize("logistic", [True, False])
def test_trees_equal_an_exhaustive_search(data, tables, logistic, monkeypatch):
    monkeypatch.setattr(bo, "RESTAGE", 2)
    x, y, cost = data
    label = "y" if logistic else "cost"
    w = np.where(np.arange(500) % 3 == 0, 2.0, 1.0)
    first = tables.withColumn("label", F.col(label))
    second = first.withColumn("weight", F.when(F.col("k") % 3 == 0, 2.0).otherwise(1.0))
    fits = bo.fit_boosted([first, second], "k", PLAIN, 1, logistic)
    for fit, weight in zip(fits, (np.ones(500), w)):
        want = plain(x, data[1] if logistic else cost, weight, PLAIN, fit.edges, logistic)
        assert fit.margin(x) == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_partitions_and_company_do_not_change_a_fit(data, tables):
    x, *_ = data
    s = BoostSettings(rounds=3, depth=2, min_rows=2, row_share=0.6, column_share="0.5")
    df = tables.withColumn("label", F.col("y"))
    alone = bo.fit_boosted([df], "k", s, 5, True)[0]
    other = df.filter("k < 300").select("k", "label", array_to_vector(F.array(F.lit(1.0), "cost")).alias("features"))
    again = bo.fit_boosted([df.repartition(2), other, df.limit(0)], "k", s, 5, True)
    assert again[0].margin(x) == pytest.approx(alone.margin(x), rel=1e-9)
    assert [len(f.edges) for f in again] == [4, 2, 0] and again[2].trees[0].column[0] == -1


@pytest.mark.parametrize("logistic", [True, False])
def test_saved_spark_model_gives_the_same_scores(spark, data, tables, logistic, tmp_path):
    x, *_ = data
    df = tables.withColumn("label", F.col("y" if logistic else "cost"))
    fit = bo.fit_boosted([df], "k", PLAIN, 1, logistic)[0]
    path = f"file://{tmp_path}/boosted-{logistic}"
    PipelineModel(stages=[bo.to_spark(spark, fit, logistic)]).write().save(path)
    out = PipelineModel.load(path).transform(df)
    score = vector_to_array("probability")[1] if logistic else F.col("prediction")
    got = [r.s for r in out.orderBy("k").select(score.alias("s")).collect()]
    margin = fit.margin(x)
    assert got == pytest.approx(list(1 / (1 + np.exp(-margin)) if logistic else margin), rel=1e-12)
    weights = bo.to_spark(spark, fit, logistic).featureImportances.toArray()
    assert weights[:3].sum() == pytest.approx(1) and len(weights) == 3 or weights[3] == 0


def test_ranks_as_well_as_the_built_in_one(data, tables):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    x, y, _ = data
    df = tables.withColumn("label", F.col("y"))
    train, test = df.filter("k % 4 > 0"), df.filter("k % 4 = 0")
    s = BoostSettings(rounds=15, depth=3, step=0.2, row_share=1.0, column_share="all", min_rows=3)
    mine = bo.to_spark(df.sparkSession, bo.fit_boosted([train], "k", s, 1, True)[0], True)
    theirs = GBTClassifier(maxIter=15, maxDepth=3, stepSize=0.2, minInstancesPerNode=3).fit(train)
    auc = BinaryClassificationEvaluator()
    assert auc.evaluate(mine.transform(test)) > auc.evaluate(theirs.transform(test)) - 0.02


def test_histograms_of_many_tasks_are_added_by_a_shuffle(data, tables, monkeypatch):
    x, *_ = data
    df = tables.withColumn("label", F.col("y"))
    few = bo.fit_boosted([df], "k", PLAIN, 1, True)[0]
    monkeypatch.setattr(bo, "FEW_TASKS", 0)
    monkeypatch.setattr(bo, "BLOCK", 50)
    many = bo.fit_boosted([df], "k", PLAIN, 1, True)[0]
    assert many.margin(x) == pytest.approx(few.margin(x), rel=1e-9)


def test_a_pass_fills_the_cores_in_whole_rounds(spark):
    cores = spark.sparkContext.defaultParallelism
    assert bo._tasks(0, spark) == 1 and bo._tasks(3 << 20, spark) <= 4
    assert bo._tasks(cores * bo.TASK_BYTES, spark) == cores
    assert bo._tasks(10 * cores * bo.TASK_BYTES + 1, spark) == 11 * cores


def test_only_the_lighter_child_is_summed_over_the_rows(data, tables, monkeypatch):
    """The rows of a level hand over one node of a split at most; margins follow the kept rows."""
    x, *_ = data
    df = tables.withColumn("label", F.col("y"))
    whole = bo.fit_boosted([df], "k", PLAIN, 1, True)[0]
    monkeypatch.setattr(bo, "REKEEP", 1)
    seen, grown = [], bo._histograms

    def counted(blocks, trees, growing, columns, level, logistic, s, draw, above, width):
        real = type(blocks).mapPartitions

        def spied(self, f, *a, **b):
            lines = real(self, f, *a, **b)
            seen.append((level, sum(above[k][0, 0].any() for k in above), len({i for i, _ in lines.collect()})))
            return lines

        monkeypatch.setattr(type(blocks), "mapPartitions", spied)
        try:
            return grown(blocks, trees, growing, columns, level, logistic, s, draw, above, width)
        finally:
            monkeypatch.setattr(type(blocks), "mapPartitions", real)

    monkeypatch.setattr(bo, "_histograms", counted)
    again = bo.fit_boosted([df], "k", PLAIN, 1, True)[0]
    assert again.margin(x) == pytest.approx(whole.margin(x), rel=1e-9)
    assert seen and all(summed <= max(1, above) for _, above, summed in seen)
    assert any(level == 2 and summed == 2 for level, _, summed in seen)


def test_passes_spare_the_workers_search_for_cycles(spark):
    """A worker searches for cycles after every task, among all modules' objects unless they are left out."""

    def left(mine):
        n = sum(1 for _ in bo.settled(mine))
        yield n, len(gc.get_objects())

    found = spark.sparkContext.parallelize(range(8), 2).mapPartitions(left).collect()
    assert [n for n, _ in found] == [4, 4] and all(left < 10_000 for _, left in found)


@pytest.mark.parametrize("depth", [0, 3, 8])
def test_rows_reach_the_node_of_a_plain_walk(depth):
    rng = np.random.default_rng(depth)
    tree, bins = bo.Tree.empty(depth), rng.integers(0, 32, (6, 300)).astype(np.uint8)
    for at in range(2**depth - 1):
        if (at == 0 or tree.column[(at - 1) // 2] >= 0) and rng.random() < 0.8:
            tree.column[at], tree.cut[at] = rng.integers(0, 6), rng.integers(0, 31)
    want = []
    for row in bins.T:
        at = 0
        while tree.column[at] >= 0:
            at = 2 * at + 1 + int(row[tree.column[at]] > tree.cut[at])
        want.append(at)
    assert tree.place(bins).tolist() == want
    assert len(tree.column) <= 256 or tree.place(bins).dtype == np.int32
