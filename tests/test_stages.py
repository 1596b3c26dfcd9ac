import os

from pyspark.sql import functions as F

from hearthscore.config import Settings, BoostSettings, ForestSettings
from hearthscore.operators.propensity import propensity_columns, score_cost, score_products
from hearthscore.plans import stages as st
from hearthscore.session import scratch_path, shared_dir, stage_table
from hearthscore.sources import registry
from hearthscore.sources import tpch_calls as src

# The smallest test tables have too few holders for the usual minimum.
TINY = Settings(
    min_positives=10,
    boost=BoostSettings(rounds=2),
    forest=ForestSettings(trees=5, depth=3),
    logistic_iterations=20,
    huber_iterations=20,
    cost_forest=ForestSettings(trees=5, depth=3, min_rows=5, columns="all"),
    cost_boost=BoostSettings(rounds=2, row_share=1.0, column_share="all"),
    segment_range=(2, 3),
    segments=3,
    sweep_starts=1,
    segment_starts=1,
)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_stage_table_round_trip(spark):
    df = spark.range(5).withColumnRenamed("id", "a")
    assert sorted(r.a for r in stage_table(df, "t").collect()) == list(range(5))


def test_all_stages_and_restart(spark, sf):
    base = scratch_path(spark, "engine-test")
    raw = src.raw_calls(spark, sf)
    out = st.run_all(raw, base, src.PRODUCTS, TINY, src.COST_YEARS)
    households = spark.read.parquet(f"{base}/households")
    assert out.count() == households.count()
    assert out.filter("recommended_product is null").count() == 0
    names = registry.inventory(spark, f"{base}/registry").collect()
    assert {r.task for r in names} == {"classify", "regress"}
    assert all(r.feature_count == len(r.feature_names) for r in names)
    # evaluation tables agree with the summaries
    kinds = ["product", "model"]
    cards = spark.read.parquet(f"{base}/classification")
    lifts = spark.read.parquet(f"{base}/lift").groupBy(*kinds).agg(F.max("pct_captured").alias("all"))
    assert lifts.count() == cards.count() and lifts.filter("all <> 1").count() == 0
    ends = spark.read.parquet(f"{base}/roc").groupBy(*kinds).agg(F.max("tpr").alias("t"), F.max("fpr").alias("f"))
    assert ends.count() == cards.count() and ends.filter("t <> 1 or f <> 1").count() == 0
    assert spark.read.parquet(f"{base}/importances").select("target", "model").distinct().count() == cards.count()
    errors = spark.read.parquet(f"{base}/residuals").groupBy("model").agg(
        F.round(F.sqrt(F.avg(F.col("residual") ** 2)), 4).alias("rmse2"))
    costs = spark.read.parquet(f"{base}/regression").join(errors, "model")
    assert costs.count() == 4 and costs.filter("abs(rmse - rmse2) > 0.001 or verdict is null").count() == 0
    quality = spark.read.parquet(f"{base}/segment_quality").first()
    assert quality.k == 3 and quality.inertia >= 0 and -1 <= quality.silhouette <= 1
    # any stage can run again from what the ones before have stored
    assert st.stage_recommend(spark, base).count() == households.count()
    wide = score_products(households, base)
    assert len(propensity_columns(wide)) >= 2
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan, "scoring must not shuffle"
    for c in propensity_columns(wide).values():
        low, high = wide.selectExpr(f"min({c})", f"max({c})").first()
        assert 0 <= low <= high <= 1
    assert score_cost(households, base).filter("expected_cost < 0").count() == 0


def test_registry_serves_the_best_validated_model(spark):
    base = scratch_path(spark, "registry-test")
    registry.register(spark, base, [
        {"task": "classify", "target": "a", "model": m, "path": m, "roc_auc": auc, "validation": val}
        for m, auc, val in [("alpha", 0.9, 0.6), ("zeta", 0.7, 0.8)]
    ])
    assert registry.best_models(spark, base, "classify") == {"a": "zeta"}
    assert registry.best_models(spark, base, "regress") == {}
    metrics = {r.model: r.metric for r in registry.inventory(spark, f"{base}/registry").collect()}
    assert metrics == {"alpha": 0.9, "zeta": 0.7}


def test_model_is_chosen_on_validation_not_on_test(spark):
    from hearthscore.operators.selection import best_model

    cards = spark.createDataFrame([("a", "m1", 0.9, 0.6), ("a", "m2", 0.7, 0.8)],
                                  "product string, model string, roc_auc double, validation double")
    assert best_model(cards, "product", "validation").first().model == "m2"


def test_lookup(spark):
    from hearthscore.operators import lookup as lk

    df = spark.range(1000).withColumnRenamed("id", "household_key")
    assert [r.household_key for r in lk.household_keys(df, 3).collect()] == [0, 1, 2]
    draw = lk.random_household(df, 5).first()
    assert draw == lk.random_household(df.repartition(5), 5).first()
    assert lk.find_households(df, df.filter("household_key < 2")).count() == 2


def test_empty_registry_scores_nothing(spark):
    df = spark.range(3)
    assert score_products(df, scratch_path(spark, "none")).columns == ["id"]


def test_no_python_udf_on_the_main_path(spark, sf):
    from hearthscore.queries import QUERIES

    for name in ("engineer_features", "member_costs", "household_scores"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() == 150
    assert set(oracle_sql()) <= set(queries())


def test_repository_holds_no_data():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    big = [
        f for d, _, fs in os.walk(root) if ".git" not in d for f in fs
        if os.path.getsize(os.path.join(d, f)) > 1_000_000
    ]
    assert not big


def test_a_later_run_replaces_better_older_models(spark):
    base = scratch_path(spark, "registry-test")
    for model, target, value in (("old", "a", 0.85), ("gone", "b", 0.9), ("new", "a", 0.80)):
        registry.register(spark, base, [
            {"task": "classify", "target": target, "model": model, "path": model, "validation": value}
        ])
    assert registry.best_models(spark, base, "classify") == {"a": "new"}


def test_classify_and_regress_run_at_the_same_time(spark, monkeypatch):
    import threading

    from hearthscore.plans import stages

    both, seen = threading.Barrier(2, timeout=60), []

    def stage(*given):
        both.wait()
        seen.append(given[1:])

    monkeypatch.setattr(stages, "stage_classify", stage)
    monkeypatch.setattr(stages, "stage_regress", stage)
    stages.train_models(spark, "base", ["alpha"], None)
    assert seen == [("base", ["alpha"], None)] * 2
