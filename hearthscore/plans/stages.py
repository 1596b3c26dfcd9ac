"""The five stages, each restartable from the tables of the stage before.

``base`` is a folder every executor can reach; it holds the stage tables, the
models and the registry.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthscore.config import Settings
from hearthscore.functions.tiers import r2_verdict
from hearthscore.operators import models as md
from hearthscore.operators import segments as sg
from hearthscore.operators.metrics import lift_curve, residuals, roc_points
from hearthscore.operators.propensity import propensity_columns, score_products
from hearthscore.operators.recommend import attach_recommendation
from hearthscore.operators.selection import best_model
from hearthscore.plans.preprocess import preprocess
from hearthscore.sources import calls as io
from hearthscore.sources import registry

KEY = "household_key"


def stage_preprocess(raw: DataFrame, base: str, years: Sequence[int] | None = None) -> DataFrame:
    """Raw calls to the household feature table."""
    path = f"{base}/households"
    io.write_parquet(preprocess(raw, years), path)
    return io.scan_parquet(raw.sparkSession, path)


def stage_classify(
    spark: SparkSession, base: str, products: Sequence[str], settings: Settings
) -> DataFrame:
    """Train, evaluate and register the best classifier of every modelable product.

    Besides the summary it writes the scores of the held-out households
    (``held_scores``), ROC points and lift curves of the test rows (``roc``, ``lift``)
    and the leading features of every model (``importances``).
    """
    table = io.scan_parquet(spark, f"{base}/households")
    fitted, scored = md.train_all_products(table, products, settings)
    io.write_parquet(scored, f"{base}/held_scores")
    path = f"{base}/classification"
    io.write_parquet(md.classification_summary(scored), path)
    summary = io.scan_parquet(spark, path)
    test, by = scored.filter("split = 'test'"), ["product", "model"]
    io.write_parquet(roc_points(test, by), f"{base}/roc")
    io.write_parquet(lift_curve(test, by, KEY), f"{base}/lift")
    leading = [row for f in fitted for row in md.feature_importance(f)]
    io.write_parquet(spark.createDataFrame(leading, md.IMPORTANCE_SCHEMA), f"{base}/importances")
    best = {
        (r["product"], r["model"]): r.asDict()
        for r in best_model(summary, "product", "validation").collect()
    }
    rows = []
    for f in fitted:
        if (f.target, f.name) in best:
            card = best[f.target, f.name]
            rows.append(
                {
                    **card,
                    "task": "classify",
                    "target": f.target,
                    "path": registry.save_model(f.pipeline, base, "classify", f.target, f.name),
                    "feature_count": len(f.features),
                    "feature_names": f.features,
                }
            )
    if rows:
        registry.register(spark, base, rows)
    return summary


def stage_regress(
    spark: SparkSession, base: str, products: Sequence[str], settings: Settings
) -> DataFrame:
    """Train the cost models, register the best on validation rows, report test rows.

    The summary carries the R2 verdict of every model; ``residuals`` holds the
    residual of every test row, ``held_costs`` the held-out predictions.
    """
    table = io.scan_parquet(spark, f"{base}/households")
    fitted, scored = md.train_cost_models(table, products, settings)
    io.write_parquet(scored, f"{base}/held_costs")
    path = f"{base}/regression"
    verdict = r2_verdict(F.col("r2")).alias("verdict")
    io.write_parquet(md.regression_summary(scored).select("*", verdict), path)
    io.write_parquet(residuals(scored.filter("split = 'test'")), f"{base}/residuals")
    summary = io.scan_parquet(spark, path)
    held = md.regression_summary(scored, "validation").first()
    best = summary.filter(F.col("model") == held["model"]).drop("verdict").first().asDict()
    chosen = next(f for f in fitted if f.name == best["model"])
    registry.register(
        spark,
        base,
        [
            {
                **best,
                "task": "regress",
                "target": "cost",
                "validation": -held["rmse"],
                "path": registry.save_model(chosen.pipeline, base, "regress", "cost", chosen.name),
                "feature_count": len(chosen.features),
                "feature_names": chosen.features,
            }
        ],
    )
    return summary


def train_models(
    spark: SparkSession, base: str, products: Sequence[str], settings: Settings
) -> None:
    """The classify and regress stages at the same time: neither reads the other's tables.

    Their many short jobs leave most cores idle, so the two together take little
    longer than one.
    """
    stages = (stage_classify, stage_regress)
    with ThreadPoolExecutor(len(stages)) as pool:
        wrap = inheritable_thread_target(spark)
        for done in [pool.submit(wrap(stage), spark, base, products, settings) for stage in stages]:
            done.result()


def stage_cluster(spark: SparkSession, base: str, settings: Settings) -> DataFrame:
    """Segment households by their propensity scores; writes segments, their quality and actions."""
    scored_path = f"{base}/propensity"
    io.write_parquet(score_products(io.scan_parquet(spark, f"{base}/households"), base), scored_path)
    table = io.scan_parquet(spark, scored_path)
    scores = propensity_columns(table)
    if len(scores) < 2:
        raise RuntimeError("segmentation needs the scores of at least two products")
    vectors = sg.score_vector(table, list(scores.values()))
    points = vectors.select(KEY, "features").persist()
    try:
        io.write_parquet(sg.kmeans_sweep(points, KEY, settings), f"{base}/sweep")
        model = sg.fit_kmeans(
            points,
            KEY,
            settings.segments,
            settings.seed,
            settings.segment_starts,
            settings.segment_iterations,
        )
        labelled = model.transform(points)
        quality = [
            (
                settings.segments,
                model.cost,
                sg.silhouette(labelled, "features", "cluster"),
                sg.calinski_harabasz(labelled, "features", "cluster"),
            )
        ]
        io.write_parquet(spark.createDataFrame(quality, sg.QUALITY_SCHEMA), f"{base}/segment_quality")
    finally:
        points.unpersist()
    io.write_parquet(model.transform(vectors).drop("features"), f"{base}/segments")
    labelled = io.scan_parquet(spark, f"{base}/segments")
    profile = sg.profile_clusters(labelled, list(scores.values()))
    io.write_parquet(sg.action_table(profile, scores, settings.min_propensity), f"{base}/actions")
    return io.scan_parquet(spark, f"{base}/actions")


def stage_recommend(spark: SparkSession, base: str) -> DataFrame:
    """Attach segment name and offer to every household."""
    labelled = io.scan_parquet(spark, f"{base}/segments")
    actions = io.scan_parquet(spark, f"{base}/actions")
    path = f"{base}/recommendations"
    io.write_parquet(attach_recommendation(labelled, actions), path, "recommended_product")
    return io.scan_parquet(spark, path)


def run_all(
    raw: DataFrame,
    base: str,
    products: Sequence[str],
    settings: Settings,
    years: Sequence[int] | None = None,
) -> DataFrame:
    spark = raw.sparkSession
    stage_preprocess(raw, base, years)
    train_models(spark, base, products, settings)
    stage_cluster(spark, base, settings)
    return stage_recommend(spark, base)
