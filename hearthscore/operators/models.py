"""Training of propensity classifiers and cost regressors with Spark ML."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.common import _py2java
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthscore.config import Settings
from hearthscore.operators.boosting import fit_boosted, to_spark
from hearthscore.operators.clean import leakage_columns
from hearthscore.operators.explore import modelable_products
from hearthscore.operators.features import regression_target
from hearthscore.operators.forest import fit_forests
from hearthscore.operators.forest import to_spark as forest_to_spark
from hearthscore.operators.matrix import feature_names, fit_matrix
from hearthscore.operators.metrics import classification_scorecard, regression_scorecard
from hearthscore.operators.normal import Moments, best_penalty, moments_by_fold
from hearthscore.operators.split import (
    class_weights,
    hash_split,
    key_hash,
    stratified_split,
    with_class_weight,
)
from hearthscore.session import stage_table

KEY = "household_key"
SCORED_SCHEMA = (
    "household_key bigint, product string, model string, split string, y int, p double, pred int"
)
log = logging.getLogger(__name__)


@dataclass
class Fitted:
    """A trained model together with every step from household row to score."""

    target: str
    name: str
    pipeline: PipelineModel
    features: list[str]

    @property
    def model(self):
        return next(s for s in reversed(self.pipeline.stages) if hasattr(s, "predictionCol"))


# --- classifiers ----------------------------------------------------------------


def boosted_trees(train: DataFrame, s: Settings, n: int) -> list[Transformer]:
    return _boosted([train], s)[0]


def _boosted(tables: Sequence[DataFrame], s: Settings) -> list[list[Transformer]]:
    """Boosted classifiers of several products, grown in the same passes."""
    fits = fit_boosted(tables, KEY, s.boost, s.seed, logistic=True)
    return [[to_spark(table.sparkSession, f, logistic=True)] for table, f in zip(tables, fits)]


def random_forest(train: DataFrame, s: Settings, n: int) -> list[Transformer]:
    return _forests([train], s)[0]


def _forests(tables: Sequence[DataFrame], s: Settings) -> list[list[Transformer]]:
    """Forests of several products, grown in the same passes."""
    if not tables:
        return []
    spark = tables[0].sparkSession

    def made(fit) -> list[Transformer]:
        return [forest_to_spark(spark, fit, s.forest, s.seed, classify=True)]

    with ThreadPoolExecutor(s.fit_threads) as pool:
        return list(pool.map(inheritable_thread_target(spark)(made), fit_forests(tables, KEY, s.forest, s.seed, classify=True)))


def logistic_regression(train: DataFrame, s: Settings, n: int) -> list[Transformer]:
    """L2 penalty of strength 1 on columns of population deviation 1.

    The intercept is free, so centring would not change the optimum and the
    sparse indicators can stay sparse.  Spark's scaler uses the sample deviation
    (hence the factor (n - 1) / n) and its loss is a mean (hence 1 / n).
    """
    scaler = _scaler(train)
    model = LogisticRegression(
        featuresCol="scaled",
        labelCol="label",
        weightCol="weight",
        regParam=(n - 1) / n / n,
        elasticNetParam=0.0,
        standardization=False,
        maxIter=s.logistic_iterations,
    ).fit(scaler.transform(train))
    return [scaler, model]


def _scaler(train: DataFrame):
    return StandardScaler(
        inputCol="features", outputCol="scaled", withMean=False, withStd=True
    ).fit(train)


CLASSIFIERS: dict[str, Callable] = {
    "boosted_trees": boosted_trees,
    "random_forest": random_forest,
    "logistic_regression": logistic_regression,
}
TOGETHER: dict[str, Callable] = {"boosted_trees": _boosted, "random_forest": _forests}  # all products at once


def _other_products(product: str) -> SQLTransformer:
    """Product depth without the product to be predicted, at train and score time."""
    others = f"product_count - coalesce(`{product}`, 0)"
    return SQLTransformer(
        statement=f"select *, {others} as other_products, cast({others} >= 2 as int) as other_multi"
        " from __THIS__"
    )


@dataclass
class Prepared:
    """One product's matrix over all its households, persisted, and the steps that made it."""

    product: str
    matrix: PipelineModel
    ready: DataFrame
    slots: list[str]

    @property
    def train(self) -> DataFrame:
        return self.ready.filter("split = 'train'")


def _prepare(
    table: DataFrame, product: str, products: Sequence[str], settings: Settings
) -> Prepared | None:
    labelled = table.withColumn("label", F.coalesce(F.col(product), F.lit(0)).cast("int"))
    split = stratified_split(
        labelled, KEY, "label", settings.test_share, settings.validation_share, settings.seed
    )
    train = split.filter("split = 'train'")
    weights = class_weights(train, "label")
    if len(weights) < 2:
        log.warning("%s: the training rows hold one class, no model", product)
        return None
    drop = [KEY, "label", "split", *products]
    first = []
    if settings.leave_one_out:
        drop += ["product_count", "is_multi_product"]
        first.append(_other_products(product))
    matrix = fit_matrix(train, drop, first)
    ready = matrix.transform(split).select(KEY, "label", "split", "features")
    use = weights if settings.balanced else {}
    slots = feature_names(ready)
    return Prepared(product, matrix, with_class_weight(ready, "label", use).persist(), slots)


def _fit(
    p: Prepared, settings: Settings, names: Sequence[str], known: dict[str, list[Transformer]]
) -> tuple[list[Fitted], DataFrame | None]:
    """Fit what is not ``known`` yet; score the held-out households with every model."""
    fitted, scored = [], []
    n = p.train.count()
    held = p.ready.filter("split <> 'train'")
    for name in names:
        stages = known.get(name) or CLASSIFIERS[name](p.train, settings, n)
        model = PipelineModel(stages=[*p.matrix.stages, *stages])
        fitted.append(Fitted(p.product, name, model, p.slots))
        out = held
        for stage in stages:
            out = stage.transform(out)
        scored.append(
            out.select(
                F.col(KEY),
                F.lit(p.product).alias("product"),
                F.lit(name).alias("model"),
                "split",
                F.col("label").alias("y"),
                vector_to_array("probability")[1].alias("p"),
                F.col("prediction").cast("int").alias("pred"),
            )
        )
    if not scored:
        return [], None
    return fitted, stage_table(reduce(DataFrame.unionByName, scored), f"scored-{p.product}")


def train_product(
    table: DataFrame,
    product: str,
    products: Sequence[str],
    settings: Settings,
    names: Sequence[str] | None = None,
) -> tuple[list[Fitted], DataFrame | None]:
    """Fit every classifier for one product and score the held-out households.

    A product whose training rows hold a single class is logged and gives no model;
    any failure of an estimator is raised.
    """
    p = _prepare(table, product, products, settings)
    if p is None:
        return [], None
    try:
        return _fit(p, settings, list(CLASSIFIERS) if names is None else names, {})
    finally:
        p.ready.unpersist()


def train_all_products(
    table: DataFrame,
    products: Sequence[str],
    settings: Settings,
    names: Sequence[str] | None = None,
) -> tuple[list[Fitted], DataFrame]:
    """All classifiers of all modelable products, and their scored held-out rows.

    Trees of all products grow in the same passes, and meanwhile the other
    estimators are fitted from a few driver threads: the fits are independent jobs
    and fill each other's gaps.
    """
    spark = table.sparkSession
    wrap = inheritable_thread_target(spark)
    names = list(CLASSIFIERS) if names is None else names
    chosen = sorted(r.product for r in modelable_products(table, products, settings).collect())
    for product in sorted(set(products) - set(chosen)):
        log.info("%s has too few holders to be modelled", product)

    def prepare(product: str):
        return _prepare(table, product, products, settings)

    def grow(name: str) -> list[list[Transformer]]:
        return TOGETHER[name]([p.train for p in prepared], settings)

    def fit(job: tuple[Prepared, str]) -> list[Transformer]:
        p, name = job
        return CLASSIFIERS[name](p.train, settings, p.train.count())

    def score(p: Prepared):
        return _fit(p, settings, names, known[p.product])

    with ThreadPoolExecutor(settings.fit_threads + len(TOGETHER)) as pool:
        made = pool.map(wrap(prepare), chosen)
        prepared = [p for p in made if p is not None]
        known: dict[str, dict] = {p.product: {} for p in prepared}
        try:
            together = {name: pool.submit(wrap(grow), name) for name in names if name in TOGETHER}
            jobs = [(p, name) for p in prepared for name in names if name not in TOGETHER]
            for (p, name), stages in zip(jobs, pool.map(wrap(fit), jobs)):
                known[p.product][name] = stages
            for name, grown in together.items():
                for p, stages in zip(prepared, grown.result()):
                    known[p.product][name] = stages
            results = list(pool.map(wrap(score), prepared))
        finally:
            for p in prepared:
                p.ready.unpersist()
    fitted = [f for models, _ in results for f in models]
    scored = [s for _, s in results if s is not None]
    if not scored:
        return [], spark.createDataFrame([], SCORED_SCHEMA)
    return fitted, reduce(DataFrame.unionByName, scored)


def classification_summary(scored: DataFrame) -> DataFrame:
    """One row per (product, model): test metrics, and the validation AUC to choose by."""
    cards = classification_scorecard(scored, ["product", "model", "split"], KEY)
    test = cards.filter("split = 'test'").drop("split")
    chosen_by = cards.filter("split = 'validation'").select(
        "product", "model", F.col("roc_auc").alias("validation")
    )
    return test.join(chosen_by, ["product", "model"], "left").orderBy(
        "product", F.desc("roc_auc"), "model"
    )


def feature_importance(fitted: Fitted, top: int = 20):
    """Largest importances (trees) or absolute coefficients (linear), as rows."""
    model = fitted.model
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    else:
        values = abs(model.coefficients.toArray())
    ranked = sorted(zip(fitted.features, values), key=lambda x: (-x[1], x[0]))[:top]
    return [
        (fitted.target, fitted.name, place, feature, float(value))
        for place, (feature, value) in enumerate(ranked, 1)
    ]


IMPORTANCE_SCHEMA = "target string, model string, place int, feature string, importance double"


# --- cost regressors --------------------------------------------------------------


WIDEST_GRAM = 1024  # columns; a task holds one square matrix of doubles per fold


def ridge(train: DataFrame, s: Settings, n: int) -> list[Transformer]:
    """Ridge on log(1 + cost), penalty chosen by cross-validated R2.

    The penalty is on columns of population deviation 1.  All folds and penalties
    are solved from one pass of sufficient statistics.  Beyond ``WIDEST_GRAM``
    columns the same problem is solved by an iterative method.
    """
    scaler = _scaler(train)
    fold = F.pmod(key_hash(KEY, s.seed + 1), F.lit(s.folds)).cast("int")
    if scaler.mean.size > WIDEST_GRAM:
        return [scaler, _iterative_ridge(scaler.transform(train), fold, s, n), _to_cost("expm1(prediction)")]
    # The scaler divides by the sample deviation, the penalty is meant for the population one.
    factor = ((n - 1) / n) ** 0.5 if n > 1 else 1.0
    deviation = scaler.std.toArray() * factor
    folds = moments_by_fold(train, "features", "log_target", fold, scaler.mean, deviation)
    penalty = best_penalty(folds, s.ridge_alphas)
    slopes, intercept = Moments(sum(m.gram for m in folds.values())).solve(penalty)
    slopes = np.where(deviation > 0, slopes, 0.0)
    centre = np.divide(scaler.mean.toArray(), deviation, out=np.zeros(len(slopes)), where=deviation > 0)
    line = _line(train, slopes / factor, intercept - float(slopes @ centre))
    return [scaler, line, _to_cost("expm1(prediction)")]


def _line(df: DataFrame, coefficients: np.ndarray, intercept: float) -> LinearRegressionModel:
    """A linear model with given coefficients on ``scaled``, saved and loaded like a fitted one."""
    sc = df.sparkSession.sparkContext
    vector = _py2java(sc, Vectors.dense(coefficients))
    name = f"ridge_{uuid.uuid4().hex[:12]}"
    model = sc._jvm.org.apache.spark.ml.regression.LinearRegressionModel(name, vector, float(intercept))
    return LinearRegressionModel(model).setFeaturesCol("scaled")


def _iterative_ridge(ready: DataFrame, fold, s: Settings, n: int) -> LinearRegressionModel:
    """alpha / n * sd(y) turns the penalty on a sum into Spark's on a mean over a label of deviation 1."""
    ready = ready.withColumn("fold", fold)
    unit = ready.agg(F.stddev_samp("log_target")).first()[0] or 1.0
    line = LinearRegression(
        featuresCol="scaled",
        labelCol="log_target",
        elasticNetParam=0.0,
        standardization=False,
        solver="l-bfgs",
        maxIter=s.logistic_iterations,
        tol=1e-8,
    )
    penalties = [a / n * (n - 1) / n * unit for a in s.ridge_alphas]
    grid = ParamGridBuilder().addGrid(line.regParam, penalties).build()
    cv = CrossValidator(
        estimator=line,
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(labelCol="log_target", metricName="r2"),
        numFolds=s.folds,
        foldCol="fold",
        parallelism=s.fit_threads,
    )
    ready = ready.persist()
    try:
        return cv.fit(ready).bestModel
    finally:
        ready.unpersist()


def huber(train: DataFrame, s: Settings, n: int) -> list[Transformer]:
    """Huber loss on cost in units of its deviation.

    The loss scales with the target, so the unit only speeds up convergence; the
    small penalty is adjusted to keep its strength.
    """
    scaler = _scaler(train)
    unit = train.agg(F.stddev_samp("target")).first()[0] or 1.0
    ready = scaler.transform(train).withColumn("scaled_target", F.col("target") / F.lit(unit))
    model = LinearRegression(
        featuresCol="scaled",
        labelCol="scaled_target",
        loss="huber",
        epsilon=s.huber_epsilon,
        maxIter=s.huber_iterations,
        regParam=1e-4 / n * unit,
        standardization=False,
    ).fit(ready)
    return [scaler, model, _to_cost(f"prediction * {unit!r}D")]


def cost_forest(train: DataFrame, s: Settings, n: int) -> list[Transformer]:
    labelled = train.withColumn("label", F.col("target"))
    fit = fit_forests([labelled], KEY, s.cost_forest, s.seed, classify=False)[0]
    return [forest_to_spark(train.sparkSession, fit, s.cost_forest, s.seed, classify=False), _to_cost("prediction")]


def cost_boost(train: DataFrame, s: Settings, n: int) -> list[Transformer]:
    labelled = train.withColumn("label", F.col("target"))
    fit = fit_boosted([labelled], KEY, s.cost_boost, s.seed, logistic=False)[0]
    return [to_spark(train.sparkSession, fit, logistic=False), _to_cost("prediction")]


def _to_cost(expression: str) -> SQLTransformer:
    """Prediction in money, never negative."""
    return SQLTransformer(
        statement=f"select *, greatest({expression}, cast(0 as double)) as yhat from __THIS__"
    )


REGRESSORS: dict[str, Callable] = {
    "ridge": ridge,
    "huber": huber,
    "random_forest": cost_forest,
    "gradient_boosting": cost_boost,
}


def train_cost_models(
    table: DataFrame,
    products: Sequence[str],
    settings: Settings,
    names: Sequence[str] | None = None,
) -> tuple[list[Fitted], DataFrame]:
    """Fit the cost models on features free of cost; predict validation and test rows."""
    base = regression_target(table)
    base = base.withColumn("target", F.col("target").cast("double"))
    leaks = leakage_columns(table.columns)
    split = hash_split(
        base, KEY, settings.test_share, settings.seed, settings.validation_share
    )
    split = split.withColumn("log_target", F.log1p("target"))
    train = split.filter("split = 'train'")
    drop = [KEY, "target", "log_target", "split", *products, *leaks]
    matrix = fit_matrix(train, drop)
    ready = matrix.transform(split).select(KEY, "target", "log_target", "split", "features").persist()
    fitted, scored = [], []
    try:
        inputs = ready.filter("split = 'train'")
        held = ready.filter("split != 'train'")
        n = inputs.count()
        slots = feature_names(ready)
        names = list(names or REGRESSORS)

        def fit(name: str) -> list[Transformer]:
            return REGRESSORS[name](inputs, settings, n)

        with ThreadPoolExecutor(settings.fit_threads) as pool:  # independent jobs, as above
            made = list(pool.map(inheritable_thread_target(table.sparkSession)(fit), names))
        for name, stages in zip(names, made):
            fitted.append(Fitted("cost", name, PipelineModel(stages=[*matrix.stages, *stages]), slots))
            out = held
            for stage in stages:
                out = stage.transform(out)
            scored.append(
                out.select(KEY, F.lit(name).alias("model"), "split", F.col("target").alias("y"), "yhat")
            )
        return fitted, stage_table(reduce(DataFrame.unionByName, scored), "cost-scored")
    finally:
        ready.unpersist()


def regression_summary(scored: DataFrame, split: str = "test") -> DataFrame:
    return regression_scorecard(scored.filter(F.col("split") == split), ["model"]).orderBy("rmse", "model")
