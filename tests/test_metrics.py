import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthscore.config import Settings
from hearthscore.operators import metrics as mt
from hearthscore.operators import recommend as rc
from hearthscore.operators import selection as sel
from hearthscore.operators import split as sp


def scored(spark, y, p):
    return spark.createDataFrame(
        [(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))], "key long, y int, p double"
    )


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return float(((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg)))


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(0)
    y = (rng.random(300) < 0.25).astype(int)
    p = np.round(np.clip(0.6 * y + 0.4 * rng.random(300), 0, 1), 2)
    return y, p


def test_lift_of_a_perfect_order(spark):
    df = scored(spark, [1, 1, 1] + [0] * 7, np.linspace(1, 0.1, 10))
    assert mt.lift_at_k(df, 0.30).first().lift == pytest.approx(1 / 0.3)


def test_lift_without_positives_is_zero(spark):
    assert mt.lift_at_k(scored(spark, [0] * 10, np.linspace(0, 1, 10))).first().lift == 0.0


def test_lift_of_everyone_is_one(spark, sample):
    assert mt.lift_at_k(scored(spark, *sample), 1.0).first().lift == pytest.approx(1.0)


def test_lift_of_random_scores(spark):
    rng = np.random.default_rng(1)
    df = scored(spark, (rng.random(1000) < 0.3).astype(int), rng.random(1000))
    assert 0.5 < mt.lift_at_k(df).first().lift < 2.0


def test_top_share_breaks_ties_by_key(spark):
    df = scored(spark, [0, 1, 0, 1, 0, 1, 0, 1, 0, 1], [0.9] + [0.5] * 9)
    assert sorted(r.key for r in mt.top_k_percent(df, 0.35).collect()) == [0, 1, 2]


def test_all_rows_tied(spark):
    df = scored(spark, [1, 0] * 50, [0.5] * 100)
    assert sorted(r.key for r in mt.top_k_percent(df, 0.1).collect()) == list(range(10))
    assert mt.roc_auc(df).first().roc_auc == 0.5


def test_auc_against_all_pairs(spark, sample):
    y, p = sample
    assert mt.roc_auc(scored(spark, y, p)).first().roc_auc == pytest.approx(brute_auc(y, p), abs=1e-12)


def test_perfect_classifier(spark):
    df = scored(spark, [0, 0, 0, 1, 1, 1], [0.1, 0.1, 0.1, 0.9, 0.9, 0.9])
    card = mt.classification_scorecard(df.withColumn("model", F.lit("m")), ["model"]).first()
    assert (card.roc_auc, card.f1, card.precision, card.recall) == (1.0, 1.0, 1.0, 1.0)


def test_scorecard_values(spark, sample):
    y, p = sample
    df = scored(spark, y, p).withColumn("model", F.lit("m"))
    card = mt.classification_scorecard(df, ["model"]).first()
    d = p > 0.5
    tp, fp, fn = (d & (y == 1)).sum(), (d & (y == 0)).sum(), (~d & (y == 1)).sum()
    assert card.precision == pytest.approx(tp / (tp + fp), abs=1e-4)
    assert card.recall == pytest.approx(tp / (tp + fn), abs=1e-4)
    assert card.roc_auc == pytest.approx(brute_auc(y, p), abs=1e-4)


def test_nothing_predicted_gives_zero_not_an_error(spark):
    row = mt.precision_recall_f1(scored(spark, [1, 0], [0.1, 0.2])).first()
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)


def test_roc_ends_at_one(spark, sample):
    pts = sorted(mt.roc_points(scored(spark, *sample)).collect(), key=lambda r: -r.threshold)
    assert (pts[-1].tpr, pts[-1].fpr) == (1.0, 1.0)
    assert all(a.tpr <= b.tpr and a.fpr <= b.fpr for a, b in zip(pts, pts[1:]))


def test_two_lifts_differ_for_few_rows(spark):
    """max(1, int(n k)) rows against the last prefix within k, else 1."""
    df = scored(spark, [1, 0, 0, 0, 0], [0.9, 0.8, 0.7, 0.6, 0.5])
    assert mt.lift_at_k(df, 0.1).first().lift == 5.0
    assert mt.curve_lift_at(mt.lift_curve(df), 0.1).first().lift == 1.0


def test_regression_scorecard(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)], "y double, yhat double")
    card = mt.regression_scorecard(df).first()
    assert (card.rmse, card.mae, card.r2) == (0.0, 0.0, 1.0)


def test_groups_are_independent(spark, sample):
    y, p = sample
    df = scored(spark, y, p)
    both = df.withColumn("model", F.lit("a")).unionByName(
        df.withColumn("model", F.lit("b")).withColumn("p", 1 - F.col("p"))
    )
    out = {r.model: r.roc_auc for r in mt.roc_auc(both, ["model"]).collect()}
    assert out["a"] == pytest.approx(brute_auc(y, p)) and out["a"] + out["b"] == pytest.approx(1.0)


def test_split_is_exact_per_class_and_repeatable(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    a = sp.stratified_split(df, "id", "y", 0.2, 0.1)
    sizes = {(r.split, r.y): r["count"] for r in a.groupBy("split", "y").count().collect()}
    assert sizes == {("test", 1): 20, ("validation", 1): 10, ("train", 1): 70,
                     ("test", 0): 180, ("validation", 0): 90, ("train", 0): 630}
    b = sp.stratified_split(df.repartition(7), "id", "y", 0.2, 0.1)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    assert sp.class_weights(df, "y") == {1: 2.0, 0: 4 / 6}


def test_best_model_ties_by_name(spark):
    df = spark.createDataFrame([("a", "m2", 0.8), ("a", "m1", 0.8), ("b", "m1", 0.1)],
                               "product string, model string, roc_auc double")
    assert {r.product: r.model for r in sel.best_model(df).collect()} == {"a": "m1", "b": "m1"}


def test_campaign_numbers(spark):
    best = spark.createDataFrame([("a", 0.2, 2.5)], "product string, base_rate double, lift_at_10 double")
    row = rc.campaign_value(best, 3500, Settings()).first()
    assert (row.contacts, row.random_finds, row.model_finds, row.uplift, row.budget) == (350, 70, 175, 105, 3500)
    row = rc.contact_reduction(best, 3511, 9, Settings()).first()
    assert (row.untargeted_contacts, row.targeted_contacts, row.random_equivalent) == (31599, 351, 877)
