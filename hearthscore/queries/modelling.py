"""Model training, scoring and segmentation queries (checked by properties)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from hearthscore.config import NURTURE_LABEL, Settings
from hearthscore.operators import lookup as lk
from hearthscore.operators import models as md
from hearthscore.operators import segments as sg
from hearthscore.operators.propensity import propensity_columns, score_cost
from hearthscore.operators.propensity import score_products as apply_models
from hearthscore.operators.recommend import long_scores
from hearthscore.plans import stages as st
from hearthscore.queries.catalog import QUERIES, calls, features, query
from hearthscore.queries.oracle_base import sql
from hearthscore.session import scratch_path, stage_table
from hearthscore.sources import registry
from hearthscore.sources import tpch_calls as src

K = "household_key"
FULL = Settings()
BOOSTED, BOOSTED_COST = "boosted_trees", "gradient_boosting"


def table(spark, sf_dir):
    return stage_table(features(spark, sf_dir), "features")


# --- SQL of what a model's output must look like ---------------------------------

_HELD = """select *, case
    when place <= floor(n * 0.2::double + 0.5) then 'test'
    when place <= floor(n * 0.2::double + 0.5) + floor(n * 0.1::double + 0.5) then 'validation'
    else 'train' end as split
  from (select *, row_number() over (partition by {part} order by ('0x' || substr(md5(household_key || '-42'), 1, 15))::bigint) as place,
    count(*) over (partition by {part}) as n from {source})"""
_BLOCKS = {
    "label": " union all ".join(
        f"select household_key, '{p}' as product, coalesce({p}, 0)::bigint as y, {p} as flag from hh" for p in src.PRODUCTS
    ),
    "product": "select product from label group by 1 having avg(flag) >= 0.05 and sum(flag) >= 20",
    "held": _HELD.format(part="product, y", source="label semi join product using (product)"),
    "spent": "select household_key, 'all' as every, coalesce(total_cost_sum, 0)::double as y from hh",
    "held_cost": _HELD.format(part="every", source="spent"),
    "classifier": "select unnest(['boosted_trees', 'random_forest', 'logistic_regression']) as model",
    "regressor": "select unnest(['ridge', 'huber', 'random_forest', 'gradient_boosting']) as model",
}


def _model_sql(final: str) -> str:
    return sql(final, "hh", extra=_BLOCKS)


def _held_sql(model: str) -> str:
    return _model_sql(
        f"""select product, '{model}' as model, split, count(*) as households, sum(y)::bigint as holders,
  true as probabilities, true as consistent from held where split <> 'train' group by 1, 3"""
    )


def _held_cost_sql(model: str) -> str:
    return _model_sql(
        f"""select '{model}' as model, split, count(*) as households, round(sum(y), 2) as cost, true as non_negative
from held_cost where split <> 'train' group by split"""
    )


def _held(scored):
    """Held-out households of every model by split, each scored once, and whether the scores can be."""
    p, pred = F.col("p"), F.col("pred")
    return scored.groupBy("product", "model", "split").agg(
        F.count_distinct(K).alias("households"),
        F.sum("y").cast("bigint").alias("holders"),
        F.bool_and(F.coalesce(p.between(0, 1), F.lit(False))).alias("probabilities"),
        F.bool_and(F.when(pred == 1, p >= 0.5).otherwise(p <= 0.5)).alias("consistent"),
    )


def _held_costs(scored):
    return scored.groupBy("model", "split").agg(
        F.count_distinct(K).alias("households"),
        F.round(F.sum("y"), 2).alias("cost"),
        F.bool_and(F.coalesce(F.col("yhat") >= 0, F.lit(False))).alias("non_negative"),
    )


# --- training ------------------------------------------------------------------


def _one_classifier(name: str):
    def run(spark, sf_dir):
        _, scored = md.train_all_products(table(spark, sf_dir), src.PRODUCTS, FULL, [name])
        return _held(scored)

    return run


def _one_regressor(name: str):
    def run(spark, sf_dir):
        _, scored = md.train_cost_models(table(spark, sf_dir), src.PRODUCTS, FULL, [name])
        return _held_costs(scored)

    return run


for _name, _model in (("train_forest", "random_forest"), ("train_logistic", "logistic_regression")):
    query(_name, _held_sql(_model))(_one_classifier(_model))
for _name, _model in (("train_ridge", "ridge"), ("train_huber", "huber"), ("train_rf_regressor", "random_forest")):
    query(_name, _held_cost_sql(_model))(_one_regressor(_model))


_engines: dict[tuple[str, str], str] = {}


def _trained(spark, sf_dir) -> str:
    """Folder with households, models and registry, trained once per session and table folder.

    The queries below read its tables, as the stages themselves do.
    """
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _engines:
        base = scratch_path(spark, "engine")
        st.stage_preprocess(calls(spark, sf_dir, grouped=True), base, src.COST_YEARS)
        st.train_models(spark, base, src.PRODUCTS, FULL)
        _engines[at] = base
    return _engines[at]


def _stage(spark, sf_dir, name: str):
    return spark.read.parquet(f"{_trained(spark, sf_dir)}/{name}")


@query("train_gbt", _held_sql(BOOSTED))
def train_gbt(spark, sf_dir):
    return _held(_stage(spark, sf_dir, "held_scores").filter(F.col("model") == BOOSTED))


@query("train_gbt_regressor", _held_cost_sql(BOOSTED_COST))
def train_gbt_regressor(spark, sf_dir):
    return _held_costs(_stage(spark, sf_dir, "held_costs").filter(F.col("model") == BOOSTED_COST))


@query("classification_summary")
def classification_summary(spark, sf_dir):
    return _stage(spark, sf_dir, "classification")


@query(
    "checked_classification_summary",
    _model_sql("select product, model, true as shares, true as lift from product cross join classifier"),
)
def checked_classification_summary(spark, sf_dir):
    shares = [F.coalesce(F.col(c).between(0, 1), F.lit(True)) for c in ("roc_auc", "f1", "precision", "recall", "validation")]
    return classification_summary(spark, sf_dir).select(
        "product", "model", reduce(Column.__and__, shares).alias("shares"), (F.col("lift_at_10") >= 0).alias("lift")
    )


@query("regression_summary")
def regression_summary(spark, sf_dir):
    return _stage(spark, sf_dir, "regression").drop("verdict")


@query("checked_regression_summary", _model_sql("select model, true as errors, true as fit from regressor"))
def checked_regression_summary(spark, sf_dir):
    """A mean absolute error is at most the root of the mean square; no fit explains more than all."""
    return regression_summary(spark, sf_dir).select(
        "model", F.col("mae").between(0, F.col("rmse")).alias("errors"), (F.col("r2") <= 1).alias("fit")
    )


@query("feature_importance")
def feature_importance(spark, sf_dir):
    return _stage(spark, sf_dir, "importances")


@query(
    "checked_feature_importance",
    _model_sql("select product as target, model, 20::bigint as places, true as falling from product cross join classifier"),
)
def checked_feature_importance(spark, sf_dir):
    next_one = F.lead("importance").over(Window.partitionBy("target", "model").orderBy("place"))
    rows = feature_importance(spark, sf_dir).withColumn("falls", F.col("importance") >= F.coalesce(next_one, F.lit(0.0)))
    return rows.groupBy("target", "model").agg(
        F.count_distinct("feature").alias("places"), F.bool_and("falls").alias("falling")
    )


@query("model_registry")
def model_registry(spark, sf_dir):
    base = _trained(spark, sf_dir)
    return registry.inventory(spark, f"{base}/registry").select(
        "task", "target", "model", "feature_count", "metric", "validation"
    )


@query(
    "checked_model_registry",
    _model_sql(
        """select 'classify' as task, product as target, true as best, true as named from product
union all select 'regress', 'cost', true, true"""
    ),
)
def checked_model_registry(spark, sf_dir):
    """Every target's registered model is the best on validation rows, with the names of its features."""
    best = classification_summary(spark, sf_dir).groupBy(F.col("product").alias("target")).agg(F.max("validation").alias("top"))
    rows = registry.inventory(spark, f"{_trained(spark, sf_dir)}/registry").join(best, "target", "left")
    return rows.select(
        "task",
        "target",
        F.coalesce(F.col("validation") == F.col("top"), F.col("task") == "regress").alias("best"),
        (F.size("feature_names") == F.col("feature_count")).alias("named"),
    )


@query("score_products")
def score_products(spark, sf_dir):
    base = _trained(spark, sf_dir)
    wide = apply_models(spark.read.parquet(f"{base}/households"), base)
    return long_scores(wide, K, propensity_columns(wide))


@query("checked_score_products", _model_sql("select household_key, product, true as probability from hh cross join product"))
def checked_score_products(spark, sf_dir):
    return score_products(spark, sf_dir).select(K, "product", F.col("score").between(0, 1).alias("probability"))


@query("score_households")
def score_households(spark, sf_dir):
    base = _trained(spark, sf_dir)
    asked = src.table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    asked = asked.select(F.col("c_custkey").alias(K))
    return lk.score_households(spark.read.parquet(f"{base}/households"), asked, base)


@query(
    "checked_score_households",
    _model_sql(
        """select household_key, count(*) as products, count(*) as places, true as falling
from hh join customer on c_custkey = household_key and c_acctbal < 0 cross join product group by 1"""
    ),
)
def checked_score_households(spark, sf_dir):
    before = F.lag("score").over(Window.partitionBy(K).orderBy("place"))
    rows = score_households(spark, sf_dir).withColumn("falls", F.coalesce(F.col("score") <= before, F.lit(True)))
    return rows.groupBy(K).agg(
        F.count_distinct("product").alias("products"),
        F.max("place").cast("bigint").alias("places"),
        F.bool_and("falls").alias("falling"),
    )


@query("expected_cost")
def expected_cost(spark, sf_dir):
    base = _trained(spark, sf_dir)
    return score_cost(spark.read.parquet(f"{base}/households"), base).select(K, "expected_cost")


@query("checked_expected_cost", _model_sql("select household_key, true as non_negative from hh"))
def checked_expected_cost(spark, sf_dir):
    return expected_cost(spark, sf_dir).select(K, (F.col("expected_cost") >= 0).alias("non_negative"))


# --- segments ------------------------------------------------------------------


def _vectors(spark, sf_dir):
    base = _trained(spark, sf_dir)
    wide = stage_table(apply_models(spark.read.parquet(f"{base}/households"), base), "propensity")
    return sg.score_vector(wide, list(propensity_columns(wide).values())).select(K, "features")


@query("kmeans_sweep")
def kmeans_sweep(spark, sf_dir):
    vectors = _vectors(spark, sf_dir).persist()
    try:
        return sg.kmeans_sweep(vectors, K, FULL)
    finally:
        vectors.unpersist()


@query("segment_households")
def segment_households(spark, sf_dir):
    vectors = stage_table(_vectors(spark, sf_dir), "vectors")
    s = FULL
    model = sg.fit_kmeans(vectors, K, s.segments, s.seed, s.segment_starts, s.segment_iterations)
    return model.transform(vectors).select(K, "cluster")


@query(
    "checked_kmeans_sweep",
    "select unnest(range(2, 12))::int as k, true as inertia_falls, true as silhouette, true as calinski_harabasz",
)
def checked_kmeans_sweep(spark, sf_dir):
    """More clusters never fit worse (best of ten starts each); both qualities are in their ranges."""
    before = F.lag("inertia").over(Window.orderBy("k"))  # ten rows
    return kmeans_sweep(spark, sf_dir).select(
        "k",
        F.coalesce(F.col("inertia") <= before * 1.01, F.lit(True)).alias("inertia_falls"),
        F.col("silhouette").between(-1, 1).alias("silhouette"),
        (F.col("calinski_harabasz") > 0).alias("calinski_harabasz"),
    )


@query("checked_segment_households", _model_sql("select household_key, true as known, 8::bigint as segments from hh"))
def checked_segment_households(spark, sf_dir):
    found = stage_table(segment_households(spark, sf_dir), "found")
    used = found.agg(F.count_distinct("cluster").alias("segments"))
    return found.select(K, F.col("cluster").between(0, FULL.segments - 1).alias("known")).join(F.broadcast(used), F.lit(True))


@query("run_stage")
def run_stage(spark, sf_dir):
    """The last two stages on the tables of the first three."""
    base = _trained(spark, sf_dir)
    st.stage_cluster(spark, base, FULL)
    return st.stage_recommend(spark, base).select(K, "cluster", "cluster_name", "recommended_product")


@query("checked_run_stage", _model_sql("select household_key, true as offered, true as named from hh"))
def checked_run_stage(spark, sf_dir):
    """Every household gets the offer of its segment: a modelled product or the nurture label."""
    out = run_stage(spark, sf_dir)
    offers = [NURTURE_LABEL, *(r["product"] for r in classification_summary(spark, sf_dir).select("product").distinct().collect())]
    return out.select(
        K, F.col("recommended_product").isin(offers).alias("offered"), F.col("cluster_name").isNotNull().alias("named")
    )


# Queries that need trained products: the smallest tables have none.
TRAINED = {n for n in QUERIES if n.startswith("checked_")} | {"train_gbt", "train_forest", "train_logistic"}
