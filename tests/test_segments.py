import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from hearthscore.config import NURTURE_LABEL, Settings
from hearthscore.operators import recommend as rc
from hearthscore.operators import segments as sg

SMALL = Settings(segment_range=(2, 3, 4, 5), sweep_starts=2, segment_starts=2)


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(42)
    centres = [np.zeros(5), np.full(5, 8.0), np.array([0, 8, 0, 8, 0.0])]
    rows = [
        (i * 40 + j, (rng.standard_normal(5) + c).tolist(), i)
        for i, c in enumerate(centres)
        for j in range(40)
    ]
    df = spark.createDataFrame(rows, "id long, v array<double>, truth int")
    return df.withColumn("features", array_to_vector("v")).persist()


def brute_silhouette(x, labels):
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    out = []
    for i in range(len(x)):
        same = labels == labels[i]
        if same.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == l].mean() for l in set(labels) if l != labels[i])
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_quality_measures_against_brute_force(blobs):
    rows = blobs.collect()
    x, t = np.array([r.v for r in rows]), np.array([r.truth for r in rows])
    centres = np.array([x[t == k].mean(0) for k in range(3)])
    within = ((x - centres[t]) ** 2).sum()
    assert sg.inertia(blobs, "features", "truth") == pytest.approx(within)
    between = sum((t == k).sum() * ((centres[k] - x.mean(0)) ** 2).sum() for k in range(3))
    assert sg.calinski_harabasz(blobs, "features", "truth") == pytest.approx(between / 2 / (within / 117))
    assert sg.silhouette(blobs, "features", "truth") == pytest.approx(brute_silhouette(x, t))


def test_sweep(blobs):
    rows = sg.kmeans_sweep(blobs, "id", SMALL).orderBy("k").collect()
    assert [r.k for r in rows] == [2, 3, 4, 5]
    cost = [r.inertia for r in rows]
    assert cost == sorted(cost, reverse=True)
    assert all(-1 <= r.silhouette <= 1 for r in rows)
    best = sg.best_k(blobs.sparkSession.createDataFrame(rows)).first()
    assert best.k == 3 and best.silhouette > 0.5


def test_fit_is_repeatable(blobs):
    a, b = (sg.fit_kmeans(blobs, "id", 3, 42, 2, 100) for _ in range(2))
    assert a.cost == pytest.approx(b.cost, rel=1e-9)
    labels = [
        {r.id: r.cluster for r in m.transform(blobs).select("id", "cluster").collect()} for m in (a, b)
    ]
    assert labels[0] == labels[1]


def test_score_vector_has_population_scale(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0)], "id long, s double")
    got = sorted(r.features[0] for r in sg.score_vector(df, ["s"]).collect())
    assert got == pytest.approx([-1.0, 1.0])


PROFILE = "cluster int, p_a double, p_b double, product_count double, total_ers_calls double," \
          " income_mean double, member_tenure_years_mean double, has_used_ers double, cluster_size long"
SCORES = {"a": "p_a", "b": "p_b"}


def test_names_first_rule_wins(spark):
    rows = [
        (0, 0.1, 0.2, 2.5, 9.0, 2e5, 20.0, 0.5, 1),
        (1, 0.1, 0.2, 1.0, 2.1, 2e5, 20.0, 0.5, 1),
        (2, 0.1, 0.2, 1.0, 2.0, 100001.0, 20.0, 0.5, 1),
        (3, 0.1, 0.2, 1.0, 2.0, 1e5, 15.1, 0.5, 1),
        (4, 0.1, 0.31, 1.0, 2.0, 1e5, 15.0, 0.5, 1),
        (5, 0.1, 0.30, 1.0, 2.0, None, 15.0, 0.5, 1),
    ]
    out = sg.name_segments(spark.createDataFrame(rows, PROFILE), SCORES)
    assert [r.cluster_name for r in out.orderBy("cluster").collect()] == [
        "Loyal Multi-Product Members", "High ERS Utilizers", "High-Income Prospects",
        "Long-Tenure Single-Product", "b Aficionados", "General Segment 5",
    ]


def test_action_table_offers_and_nurture(spark):
    rows = [(0, 0.1, 0.14, 1.0, 0.0, 1e4, 1.04, 0.55, 7), (1, 0.15, 0.15, 1.0, 0.0, 1e4, 1.0, 0.5, 3),
            (2, 0.0, 0.0, 0.0, 0.0, None, 1.0, 0.5, 2)]
    out = sg.action_table(spark.createDataFrame(rows, PROFILE), SCORES).collect()
    assert [r.cluster for r in out] == [1, 0, 2]
    assert [r.recommended_product for r in out] == ["a", NURTURE_LABEL, NURTURE_LABEL]
    assert out[1].avg_propensity == 0.14 and out[1].avg_tenure_years == 1.0


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(0, 5.0, 1.0), (1, 5.0, 3.0)], "cluster int, x double, y double")
    out = {(r.cluster, r.feature): r.scaled for r in sg.normalised_profile(df, ["x", "y"]).collect()}
    assert out == {(0, "x"): 0.0, (1, "x"): 0.0, (0, "y"): 0.0, (1, "y"): 1.0}


def test_household_offers(spark):
    wide = spark.createDataFrame([(1, 0.15, 0.1), (2, 0.2, 0.6), (3, 0.0, 0.0)],
                                 "household_key long, p_a double, p_b double")
    out = {r.household_key: r for r in rc.household_top_offer(wide, "household_key", SCORES).collect()}
    assert out[1].offer == NURTURE_LABEL and out[1].top_product == "a"
    assert out[2].offer == "b"
    ranked = rc.household_scores(wide.filter("household_key = 2"), "household_key", SCORES).collect()
    assert [(r.place, r["product"], r.tier) for r in ranked] == [(1, "b", "high"), (2, "a", "low")]


def test_profile_uses_scores_not_ownership(spark):
    df = spark.createDataFrame([(0, 0.4, 1), (0, 0.2, 0)], "cluster int, p_a double, a int")
    row = sg.profile_clusters(df, ["p_a"]).first()
    assert row.p_a == 0.3 and row.cluster_size == 2 and "a" not in row.asDict()


def test_recommendation_shares(spark):
    households = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "household_key long, cluster int")
    actions = spark.createDataFrame([(0, "x", "a"), (1, "y", NURTURE_LABEL)],
                                    "cluster int, cluster_name string, recommended_product string")
    rec = rc.attach_recommendation(households, actions)
    out = {r.recommended_product: r.share_pct for r in rc.recommendation_distribution(rec).collect()}
    assert out == {"a": 66.7, NURTURE_LABEL: 33.3}
    assert {r.is_nurture: r.n for r in rc.nurture_split(rec).collect()} == {True: 1, False: 2}
    assert rec.filter(F.col("cluster_name").isNull()).count() == 0


def test_fits_together_equal_fits_alone(blobs):
    fits = [(2, 1), (3, 2), (5, 3), (5, 4)]
    together = sg.fit_many(blobs.repartition(7), "id", fits, 100)
    for fit, got in zip(fits, together):
        (alone,) = sg.fit_many(blobs.repartition(2), "id", [fit], 100)
        assert got.centres == pytest.approx(alone.centres) and got.cost == pytest.approx(alone.cost)


def test_fit_is_a_fixed_point_of_all_rows(blobs):
    """Every centre is the mean of the rows nearest to it, and the cost is their distance."""
    fit = sg.fit_kmeans(blobs, "id", 4, 7, 3, 300)
    rows = fit.transform(blobs).collect()
    x, label = np.array([r.v for r in rows]), np.array([r.cluster for r in rows])
    distance = ((x[:, None] - fit.centres[None]) ** 2).sum(-1)
    assert (distance.argmin(1) == label).all()
    assert fit.cost == pytest.approx(distance.min(1).sum())
    assert fit.centres == pytest.approx(np.array([x[label == k].mean(0) for k in range(4)]), abs=1e-3)


def test_more_clusters_than_distinct_points(spark):
    df = spark.createDataFrame([(i, [float(i % 2)]) for i in range(50)], "id long, v array<double>")
    df = df.withColumn("features", array_to_vector("v"))
    fit = sg.fit_kmeans(df, "id", 4, 1, 2, 50)
    assert fit.cost == 0 and fit.passes <= 3
    assert fit.transform(df).select("cluster").distinct().count() == 2


def test_centroid_silhouette_against_numpy(spark):
    import numpy as np
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(size=(40, 3)) + 2 * (np.arange(40) % 3)[:, None], [[50.0, 0, 0]]])
    label = np.append(np.arange(40) % 3, 9)
    rows = [([float(v) for v in r], int(c)) for r, c in zip(x, label)]
    df = spark.createDataFrame(rows, "a array<double>, c int").withColumn("v", array_to_vector("a"))
    names = np.unique(label)
    far = np.array([np.sqrt(((x - x[label == c].mean(0)) ** 2).sum(1)) for c in names]).T
    own = names[None, :] == label[:, None]
    a, b = far[own], np.where(own, np.inf, far).min(1)
    want = np.where(label == 9, 0.0, (b - a) / np.maximum(a, b)).mean()
    assert sg.centroid_silhouette(df, "v", "c") == pytest.approx(want)
    assert sg.centroid_silhouette(df.filter("c = 1"), "v", "c") is None
    assert sg.centroid_silhouette(df.limit(0), "v", "c") is None
