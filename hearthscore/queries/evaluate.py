"""Metric, split and campaign queries on deterministic scores."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from hearthscore.config import KEEP_STATUS, Settings
from hearthscore.functions import tiers
from hearthscore.operators import explore as ex
from hearthscore.operators import metrics as mt
from hearthscore.operators import recommend as rc
from hearthscore.operators import selection as sel
from hearthscore.operators import split as sp
from hearthscore.operators.household import household_rollup
from hearthscore.operators.members import cost_pivot, members_by_household
from hearthscore.queries.catalog import calls, households, plain, query
from hearthscore.queries.explore import histogram_sql
from hearthscore.queries.oracle_base import sql
from hearthscore.session import stage_table
from hearthscore.sources import tpch_calls as src

BY = ["product", "model"]
DENSE = list(src.DENSE_PRODUCTS)
SETTINGS = Settings()
THRESHOLD = 0.2


def _share_sums():
    """Number and cost of all calls, and of those of each dwelling type; no cost is null."""
    sums = {"n": F.count(F.lit(1)), "c": F.sum("total_cost")}
    for p in DENSE:
        mine = F.lower("dwelling_type") == p
        sums[f"n_{p}"] = F.count_if(mine)
        sums[f"c_{p}"] = F.sum(F.when(mine, F.col("total_cost")))
    return sums


def _shares():
    out = {}
    for p in DENSE:
        out[f"calls_{p}"] = F.col(f"n_{p}") / F.col("n")
        out[f"cost_{p}"] = F.coalesce(F.col(f"c_{p}"), F.lit(0)).cast("double") / F.col("c").cast("double")
    return out


def shares(spark, sf_dir):
    """Per household: the share of its calls and of its costs by dwelling type."""
    kept = calls(spark, sf_dir).filter(F.col("member_status").isin(*KEEP_STATUS))
    wide = kept.groupBy("household_key").agg(*[c.alias(name) for name, c in _share_sums().items()])
    return wide.select("household_key", *[c.alias(name) for name, c in _shares().items()])


def scores(spark, sf_dir):
    """(household, product, model, y, p): two share-based scores per product.

    Flags and shares come from one pass over the calls.
    """
    sums, share = _share_sums(), _shares()
    members = members_by_household(calls(spark, sf_dir, grouped=True), sums)
    table = household_rollup(members, DENSE, list(sums)).filter("members > 0")
    rows = [
        F.struct(
            F.lit(p).alias("product"),
            F.lit(m).alias("model"),
            F.col(p).alias("y"),
            share[f"{m}_{p}"].alias("p"),
        )
        for p in DENSE
        for m in ("calls", "cost")
    ]
    return stage_table(table.select("household_key", F.inline(F.array(*rows))), "scores")


def doc_scores(spark, sf_dir):
    return src.document_scores(spark, sf_dir)


_LIFT = """select product, model, n, contacted, case when pos > 0 then (top_pos / contacted) / (pos / n) else 0.0 end as lift
from (select product, model, count(*) as n, max(want) as contacted, sum(y)::bigint as pos,
    (sum(y) filter (where place <= want))::bigint as top_pos
  from (select *, row_number() over (partition by product, model order by p desc, household_key) as place,
      greatest(1, floor(count(*) over (partition by product, model) * 0.1::double))::bigint as want from score)
  group by 1, 2)"""
_AUC = """select product, model, sum(case when a.p > b.p then 1.0 when a.p = b.p then 0.5 else 0.0 end)::double
    / count(*) as roc_auc
  from (select * from score where y = 1) a join (select * from score where y = 0) b using (product, model) group by 1, 2"""
_CONF = f"""select product, model, count(*) filter (where y = 1 and p > {THRESHOLD}) as tp,
  count(*) filter (where y = 0 and p > {THRESHOLD}) as fp, count(*) filter (where y = 1 and p <= {THRESHOLD}) as fn,
  count(*) filter (where y = 0 and p <= {THRESHOLD}) as tn from score group by 1, 2"""
_PRF = f"""select product, model, coalesce(tp / nullif(tp + fp, 0), 0) as precision,
  coalesce(tp / nullif(tp + fn, 0), 0) as recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1 from ({_CONF})"""
_CARD = f"""select product, model, round(roc_auc, 4) as roc_auc, round(f1, 4) as f1, round(precision, 4) as precision,
  round(recall, 4) as recall, round(lift, 3) as lift_at_10
from ({_AUC}) join ({_PRF}) using (product, model) join ({_LIFT}) using (product, model)"""
_BEST = f"select * from ({_CARD}) qualify row_number() over (partition by product order by roc_auc desc, model) = 1"


@query("lift_at_k", sql(_LIFT, "score"))
def lift_at_k(spark, sf_dir):
    return mt.lift_at_k(scores(spark, sf_dir), 0.10, BY, "household_key")


@query("roc_auc", sql(f"select product, model, round(roc_auc, 10) as roc_auc from ({_AUC})", "score"))
def roc_auc(spark, sf_dir):
    out = mt.roc_auc(scores(spark, sf_dir), BY)
    return out.withColumn("roc_auc", F.round("roc_auc", 10))


@query("precision_recall_f1", sql(_PRF, "score"))
def precision_recall_f1(spark, sf_dir):
    return mt.precision_recall_f1(mt.with_decision(scores(spark, sf_dir), THRESHOLD), BY)


@query(
    "confusion_matrix",
    sql(f"select product, model, y, (p > {THRESHOLD})::int as pred, count(*) as n from score group by all", "score"),
)
def confusion_matrix(spark, sf_dir):
    return mt.confusion_matrix(mt.with_decision(scores(spark, sf_dir), THRESHOLD), BY)


_REPORT = f"""select product, model, '0' as class, coalesce(tn / nullif(tn + fn, 0), 0) as precision,
    coalesce(tn / nullif(tn + fp, 0), 0) as recall, coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) as f1, tn + fp as support from ({_CONF})
  union all select product, model, '1', coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0),
    coalesce(2 * tp / nullif(2 * tp + fn + fp, 0), 0), tp + fn from ({_CONF})"""


@query(
    "classification_report",
    sql(
        f"""select product, model, class, round(precision, 9) as precision, round(recall, 9) as recall, round(f1, 9) as f1, support
from (select * from ({_REPORT})
  union all select product, model, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::bigint from ({_REPORT}) group by 1, 2
  union all select product, model, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support)::bigint from ({_REPORT}) group by 1, 2
  union all select product, model, 'accuracy', (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn),
    (tp + tn) / (tp + tn + fp + fn), tp + tn + fp + fn from ({_CONF}))""",
        "score",
    ),
)
def classification_report(spark, sf_dir):
    out = mt.classification_report(mt.with_decision(scores(spark, sf_dir), THRESHOLD), BY)
    return out.withColumns({m: F.round(m, 9) for m in ("precision", "recall", "f1")})


def scorecards(spark, sf_dir):
    return mt.classification_scorecard(
        mt.with_decision(scores(spark, sf_dir), THRESHOLD), BY, "household_key"
    )


@query("classification_scorecard", sql(_CARD, "score"))
def classification_scorecard(spark, sf_dir):
    return scorecards(spark, sf_dir)


@query("best_model_per_product", sql(_BEST, "score"))
def best_model_per_product(spark, sf_dir):
    return sel.best_model(scorecards(spark, sf_dir))


@query(
    "targets_met",
    sql(
        f"select product, model, roc_auc, lift_at_10, roc_auc >= 0.7 as auc_met, lift_at_10 >= 2 as lift_met from ({_CARD})",
        "score",
    ),
)
def targets_met(spark, sf_dir):
    out = sel.targets_met(scorecards(spark, sf_dir))
    return out.select("product", "model", "roc_auc", "lift_at_10", "auc_met", "lift_met")


@query(
    "lift_band",
    sql(
        "select product, model, lift, case when lift >= 4 then 'strong' when lift >= 2.5 then 'good' else 'modest' end as band"
        f" from ({_LIFT})",
        "score",
    ),
)
def lift_band(spark, sf_dir):
    out = mt.lift_at_k(scores(spark, sf_dir), 0.10, BY, "household_key")
    return out.select(*BY, "lift", tiers.lift_band(F.col("lift")).alias("band"))


_BASE = "select product, avg(y) as base_rate from score where model = 'calls' group by 1"
_N = "(select count(*) from hh)"


def _best_with_rate(spark, sf_dir):
    table = scores(spark, sf_dir)
    cards = mt.classification_scorecard(mt.with_decision(table, THRESHOLD), BY, "household_key")
    rates = table.filter("model = 'calls'").groupBy("product").agg(F.avg("y").alias("base_rate"))
    n = table.select("household_key").distinct().count()
    return sel.best_model(cards).join(rates, "product"), n


@query(
    "campaign_value",
    sql(
        f"""select product, base_rate, lift_at_10, contacts, floor(contacts * base_rate)::bigint as random_finds,
  floor(contacts * base_rate * lift_at_10)::bigint as model_finds,
  floor(contacts * base_rate * lift_at_10)::bigint - floor(contacts * base_rate)::bigint as uplift, contacts * 10 as budget
from ({_BEST}) join ({_BASE}) using (product) cross join (select floor({_N} * 0.1::double)::bigint as contacts)""",
        "score", "hh",
    ),
)
def campaign_value(spark, sf_dir):
    best, n = _best_with_rate(spark, sf_dir)
    return rc.campaign_value(best, n, SETTINGS)


@query(
    "contact_reduction",
    sql(
        f"""select product, {_N} * {len(src.PRODUCTS)} as untargeted_contacts, contacts as targeted_contacts,
  floor(contacts * lift_at_10)::bigint as random_equivalent, floor(contacts * lift_at_10)::bigint - contacts as contacts_saved
from ({_BEST}) cross join (select floor({_N} * 0.1::double)::bigint as contacts)""",
        "score", "hh",
    ),
)
def contact_reduction(spark, sf_dir):
    best, n = _best_with_rate(spark, sf_dir)
    return rc.contact_reduction(best, n, len(src.PRODUCTS), SETTINGS)


@query(
    "propensity_profile",
    sql("select product, model, round(avg(p), 9) as mean_score, max(p) as max_score from score group by 1, 2", "score"),
)
def propensity_profile(spark, sf_dir):
    return scores(spark, sf_dir).groupBy(*BY).agg(
        F.round(F.avg("p"), 9).alias("mean_score"), F.max("p").alias("max_score")
    )


@query(
    "propensity_tier",
    sql(
        "select household_key, product, model, p,"
        " case when p > 0.5 then 'high' when p > 0.25 then 'medium' else 'low' end as tier from score",
        "score",
    ),
)
def propensity_tier(spark, sf_dir):
    out = scores(spark, sf_dir).withColumn("tier", tiers.propensity_tier(F.col("p")))
    return out.drop("y")


# --- ordered curves -----------------------------------------------------------


@query(
    "top_k_percent",
    sql(
        "select key, y, p from (select *, row_number() over (order by p desc, key) as place, count(*) over () as n"
        " from doc_score) where place <= greatest(1, floor(n * 0.1::double))",
        "doc_score",
    ),
)
def top_k_percent(spark, sf_dir):
    return mt.top_k_percent(doc_scores(spark, sf_dir), 0.10)


_CURVE = """select product, model, household_key, place as position, place / n as pct_pop,
  caught / greatest(total, 1) as pct_captured, (caught / greatest(total, 1)) / (place / n) as lift
from (select *, row_number() over w as place, sum(y) over w as caught, count(*) over (partition by product, model) as n,
    sum(y) over (partition by product, model) as total
  from score window w as (partition by product, model order by p desc, household_key rows unbounded preceding))"""


@query("lift_curve", sql(_CURVE, "score"))
def lift_curve(spark, sf_dir):
    return mt.lift_curve(scores(spark, sf_dir), BY, "household_key")


@query(
    "lift_curve_at_10",
    sql(
        f"""select product, model, coalesce(max_by(lift, position) filter (where pct_pop <= 0.1::double), 1.0) as lift
from ({_CURVE}) group by 1, 2""",
        "score",
    ),
)
def lift_curve_at_10(spark, sf_dir):
    curve = mt.lift_curve(scores(spark, sf_dir), BY, "household_key")
    return mt.curve_lift_at(curve, 0.10, BY)


@query(
    "roc_points",
    sql(
        """select product, model, p as threshold, tp, fp, coalesce(tp / nullif(pos, 0), 0) as tpr, coalesce(fp / nullif(neg, 0), 0) as fpr
from (select distinct product, model, p, (sum(y) over w)::bigint as tp, (sum(1 - y) over w)::bigint as fp,
    sum(y) over g as pos, sum(1 - y) over g as neg
  from score window w as (partition by product, model order by p desc range unbounded preceding),
    g as (partition by product, model))""",
        "score",
    ),
)
def roc_points(spark, sf_dir):
    return mt.roc_points(scores(spark, sf_dir), BY)


# --- regression ---------------------------------------------------------------

_VARIANTS = {"list": 0.0, "blend": 0.4, "close": 0.9}


def variants(spark, sf_dir):
    """Predictions that lean more and more on the true value."""
    pred = src.cost_predictions(spark, sf_dir)
    rows = [
        F.struct(
            F.lit(m).alias("model"),
            (F.lit(w) * F.col("y") + F.lit(1 - w) * F.col("yhat")).alias("yhat"),
        )
        for m, w in _VARIANTS.items()
    ]
    return pred.select("y", F.inline(F.array(*rows)))


_VARIANT_SQL = " union all ".join(
    f"select '{m}' as model, y, {w}::double * y + {1 - w}::double * yhat as yhat from pred"
    for m, w in _VARIANTS.items()
)
_REG = f"""select model, round(sqrt(avg((y - yhat) ** 2)), 4) as rmse, round(avg(abs(y - yhat)), 4) as mae,
  round(1 - avg((y - yhat) ** 2) / var_pop(y), 4) as r2 from ({_VARIANT_SQL}) group by 1"""


@query("regression_scorecard", sql(_REG, "pred"))
def regression_scorecard(spark, sf_dir):
    return mt.regression_scorecard(variants(spark, sf_dir), ["model"])


@query(
    "r2_verdict",
    sql(
        "select model, r2, case when r2 > 0.6 then 'suspicious' when r2 > 0.25 then 'good' else 'low' end as verdict,"
        f" r2 >= 0.25 as r2_met from ({_REG})",
        "pred",
    ),
)
def r2_verdict(spark, sf_dir):
    out = mt.regression_scorecard(variants(spark, sf_dir), ["model"])
    r2 = F.col("r2")
    return out.select("model", "r2", tiers.r2_verdict(r2).alias("verdict"), tiers.r2_met(r2).alias("r2_met"))


@query(
    "residuals",
    sql("select *, y - yhat as residual from pred", "pred"),
)
def residuals(spark, sf_dir):
    return mt.residuals(src.cost_predictions(spark, sf_dir))


@query(
    "residual_histogram",
    sql(
        f"select *, 'residual' as column_name from ({histogram_sql('(y - yhat)', 'pred', 40)})",
        "pred",
    ),
)
def residual_histogram(spark, sf_dir):
    res = mt.residuals(src.cost_predictions(spark, sf_dir))
    return ex.histogram(res, ["residual"], 40).withColumn("low", F.round("low", 6))


_POINTS = 101
_QQ = ", ".join(
    f"({i}, {(i + 0.5) / _POINTS!r}::double, {NormalDist().inv_cdf((i + 0.5) / _POINTS)!r}::double)"
    for i in range(_POINTS)
)
_QQ_PROBS = ", ".join(f"{(i + 0.5) / _POINTS!r}::double" for i in range(_POINTS))


@query(
    "residual_qq",
    sql(
        f"""select point, prob, theoretical, round(obs[point + 1], 6) as observed
from (values {_QQ}) t(point, prob, theoretical) cross join (select quantile_cont(y - yhat, [{_QQ_PROBS}]) as obs from pred)""",
        "pred",
    ),
)
def residual_qq(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    out = mt.residual_qq(src.cost_predictions(spark, sf_dir), keys, _POINTS)
    return out.withColumn("observed", F.round("observed", 6))


@query(
    "log_target",
    sql(
        "select member_key, total_cost::double as target, round(ln(1 + total_cost::double), 9) as logged,"
        " round(exp(ln(1 + total_cost::double)) - 1, 4) as restored from cost",
        "cost",
    ),
)
def log_target(spark, sf_dir):
    costs = cost_pivot(calls(spark, sf_dir, grouped=True), src.COST_YEARS).select(
        "member_key", F.col("total_cost").cast("double").alias("target")
    )
    return costs.withColumn("logged", F.log1p("target")).select(
        "member_key",
        "target",
        F.round("logged", 9).alias("logged"),
        F.round(F.expm1("logged"), 4).alias("restored"),
    )


@query(
    "clip_predictions",
    sql("select l_orderkey, l_linenumber, l_partkey, l_suppkey, greatest(yhat - y, 0.0::double) as clipped from pred", "pred"),
)
def clip_predictions(spark, sf_dir):
    pred = src.cost_predictions(spark, sf_dir)
    clipped = tiers.non_negative(F.col("yhat") - F.col("y")).alias("clipped")
    return pred.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", clipped)


# --- splits -------------------------------------------------------------------

_HASH = "('0x' || substr(md5(household_key || '-42'), 1, 15))::bigint"


def _split(label: str | None, test: float, val: float) -> str:
    part = f"partition by {label}" if label else ""
    return f"""select household_key, economy,
  case when place <= floor(n * {test}::double + 0.5) then 'test'
    when place <= floor(n * {test}::double + 0.5) + floor(n * {val}::double + 0.5) then 'validation' else 'train' end as split
from (select household_key, economy, row_number() over ({part} order by {_HASH}) as place, count(*) over ({part}) as n from hh)"""


def _labelled(spark, sf_dir):
    return households(spark, sf_dir).select("household_key", "economy")


@query("stratified_split", sql(_split("economy", 0.2, 0.1), "hh"))
def stratified_split(spark, sf_dir):
    return sp.stratified_split(_labelled(spark, sf_dir), "household_key", "economy", 0.2, 0.1)


@query("hash_split", sql(_split(None, 0.2, 0.0), "hh"))
def hash_split(spark, sf_dir):
    return sp.hash_split(_labelled(spark, sf_dir), "household_key", 0.2)


@query(
    "split_profile",
    sql(
        f"select split, count(*) as n, avg(economy) as positive_rate from ({_split('economy', 0.2, 0.1)}) group by 1",
        "hh",
    ),
)
def split_profile(spark, sf_dir):
    split = sp.stratified_split(_labelled(spark, sf_dir), "household_key", "economy", 0.2, 0.1)
    return sp.split_profile(split, "economy")


@query(
    "class_weights",
    sql(
        "select household_key, economy, (count(*) over ()) / (2.0::double * count(*) over (partition by economy)) as weight from hh",
        "hh",
    ),
)
def class_weights(spark, sf_dir):
    table = _labelled(spark, sf_dir)
    return sp.with_class_weight(table, "economy", sp.class_weights(table, "economy"))


_INVENTORY_CARD = f"select product as target, model, 'classify' as task, roc_auc as metric from ({_CARD})"
_INVENTORY_REG = f"select 'cost' as target, model, 'regress' as task, r2 as metric from ({_REG})"


@query(
    "model_inventory",
    sql(f"{_INVENTORY_CARD} union all {_INVENTORY_REG}", "score", "pred"),
)
def model_inventory(spark, sf_dir):
    from hearthscore.session import scratch_path
    from hearthscore.sources import registry

    path = scratch_path(spark, "inventory")
    cards = scorecards(spark, sf_dir).withColumnRenamed("product", "target")
    registry.write_metadata(cards.withColumn("task", F.lit("classify")), path)
    fits = mt.regression_scorecard(variants(spark, sf_dir), ["model"])
    fits = fits.withColumns({"task": F.lit("regress"), "target": F.lit("cost")})
    registry.write_metadata(fits, path)
    return registry.inventory(spark, path).select("task", "target", "model", "metric")
