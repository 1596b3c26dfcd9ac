"""Matrix, cluster-quality, segment and offer queries."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from hearthscore.config import MODE_COLUMNS, NURTURE_LABEL, SEGMENT_LABELS
from hearthscore.operators import matrix as mx
from hearthscore.operators import recommend as rc
from hearthscore.operators import segments as sg
from hearthscore.plans.preprocess import preprocess_pipeline
from hearthscore.queries.catalog import calls, features, households, plain, query
from hearthscore.queries.evaluate import DENSE, shares
from hearthscore.queries.households import _MEANS, _MONEY, FEATURES, K
from hearthscore.queries.oracle_base import _define, sql
from hearthscore.session import scratch_path, stage_table
from hearthscore.sources import calls as io
from hearthscore.sources import tpch_calls as src

P = {p: f"p_{p}" for p in DENSE}

# --- matrix -------------------------------------------------------------------

_INPUTS = [c for c in FEATURES if c not in (K, *MODE_COLUMNS, *src.PRODUCTS)]
_IMPUTED = [f"coalesce({c}::double, median({c}::double) over ()) as {c}" for c in _INPUTS]


@query(
    "impute_median",
    sql(f"select household_key, {', '.join(_IMPUTED)} from feat", "feat"),
)
def impute_median(spark, sf_dir):
    return mx.impute_median(features(spark, sf_dir).select(K, *_INPUTS), _INPUTS)


# Label sets of the test tables, at every size: these two queries have one column
# per listed label.  ``preprocess_matrix`` learns its labels.
_LABELS = {
    "zip": sorted(f"Brand#{i}" for i in range(1, 26)),
    "home_owner": sorted(["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "Not Set"]),
    "dwelling_type": sorted(src.TYPES),
    "mosaic_household": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "mosaic_global_household": ["A", "N", "R"],
    "kcl_b_ind_mosaicsgrouping": ["F", "O"],
}
_DUMMIES = [
    f"({c} = '{v}')::int::double as \"{mx.dummy_name(c, v)}\"" for c in MODE_COLUMNS for v in _LABELS[c]
]


@query("one_hot", sql(f"select household_key, {', '.join(_DUMMIES)} from hh", "hh"))
def one_hot(spark, sf_dir):
    return mx.one_hot(households(spark, sf_dir).select(K, *MODE_COLUMNS), MODE_COLUMNS, _LABELS)


@query(
    "build_matrix",
    sql(f"select household_key, {', '.join(_IMPUTED)}, {', '.join(_DUMMIES)} from feat", "feat"),
)
def build_matrix(spark, sf_dir):
    table = stage_table(features(spark, sf_dir), "features")
    return mx.build_matrix(table.select(*FEATURES), src.PRODUCTS, labels=_LABELS)


# The engine's slots: numbers in the order of the features, then labels by column and label.
_CELLS = " union all ".join(f"select household_key, '{c}' as col, coalesce({c}, 'Not Set') as label from feat" for c in MODE_COLUMNS)
_NUMBERS = " union all ".join(
    f"select household_key, {i} as slot, '{c}' as name, coalesce({c}::double, median({c}::double) over ()) as value from feat"
    for i, c in enumerate(_INPUTS)
)


@query(
    "preprocess_matrix",
    sql(
        f"""select household_key, slot::bigint as slot, name, value from ({_NUMBERS})
union all
select household_key, ({len(_INPUTS)} + dense_rank() over (order by col, label) - 1)::bigint, col || '=' || label, 1.0::double
from ({_CELLS})""",
        "feat",
    ),
)
def preprocess_matrix(spark, sf_dir):
    matrix, names, _ = preprocess_pipeline(calls(spark, sf_dir, grouped=True), src.COST_YEARS)
    cells = matrix.select(K, F.explode(F.arrays_zip("slots", "values")).alias("c"))
    cells = cells.select(K, F.col("c.slots").alias("slot"), F.col("c.values").alias("value"))
    return cells.join(names, "slot").select(K, "slot", "name", "value")


_SCALED = ", ".join(
    f"round(({c} - avg({c}) over ()) / coalesce(nullif(stddev_pop({c}) over (), 0), 1), 6) as {c}"
    for c in _INPUTS
)


@query(
    "standardize",
    sql(f"select household_key, {_SCALED} from (select household_key, {', '.join(_IMPUTED)} from feat)", "feat"),
)
def standardize(spark, sf_dir):
    table = stage_table(features(spark, sf_dir).select(K, *_INPUTS), "features")
    out = mx.standardize(mx.impute_median(table, _INPUTS), _INPUTS)
    return out.withColumns({c: F.round(c, 6) for c in _INPUTS})


# --- cluster quality on the labelled vectors ------------------------------------


def vectors(spark, sf_dir):
    v = src.vectors(spark, sf_dir)
    return v.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"), "label")


_DIMS = "dims as (select vec_id, label, unnest(v) as x, generate_subscripts(v, 1) as d from vecs)"
_WITHIN = "(select sum((x - m) ** 2) from dims join (select label, d, avg(x) as m from dims group by 1, 2) using (label, d))"


def _with_dims(final: str) -> str:
    return sql(final, "vecs").replace("\n" + final, f", {_DIMS}\n{final}")


@query("inertia", _with_dims(f"select round({_WITHIN}, 6) as inertia"))
def inertia(spark, sf_dir):
    value = sg.inertia(vectors(spark, sf_dir), "v", "label")
    return spark.createDataFrame([(value,)], "inertia double").select(F.round("inertia", 6).alias("inertia"))


@query(
    "calinski_harabasz",
    _with_dims(
        f"""select round(between * (n - k) / ({_WITHIN} * (k - 1)), 6) as calinski_harabasz
from (select sum(c * (m - g) ** 2) as between from (select label, d, avg(x) as m, count(*) as c from dims group by 1, 2)
    join (select d, avg(x) as g from dims group by 1) using (d))
  cross join (select count(*) as n, count(distinct label) as k from vecs)"""
    ),
)
def calinski_harabasz(spark, sf_dir):
    value = sg.calinski_harabasz(vectors(spark, sf_dir), "v", "label")
    out = spark.createDataFrame([(value,)], "calinski_harabasz double")
    return out.select(F.round("calinski_harabasz", 6).alias("calinski_harabasz"))


def _silhouette_sql(distance: str, label: str = "label", source: str = "vecs") -> str:
    return f"""select avg(case when c = 1 then 0 when greatest(a, b) = 0 then 0 else (b - a) / greatest(a, b) end)
from (select vec_id, max(own) as a, min(other) as b, max(size) as c from (
  select p.vec_id, q.l,
    case when p.l = q.l then sum({distance}) / greatest(count(*) - 1, 1) end as own,
    case when p.l <> q.l then avg({distance}) end as other,
    case when p.l = q.l then count(*) end as size
  from (select *, {label} as l from {source}) p, (select *, {label} as l from {source}) q
  group by p.vec_id, p.l, q.l) group by vec_id)"""


_SIL2 = f"select round(({_silhouette_sql('list_distance(p.v, q.v) ** 2')}), 6) as silhouette"


@query("silhouette", sql(_SIL2, "vecs"))
def silhouette(spark, sf_dir):
    value = sg.silhouette(vectors(spark, sf_dir), "v", "label")
    out = spark.createDataFrame([(value,)], "silhouette double")
    return out.select(F.round("silhouette", 6).alias("silhouette"))


@query("silhouette_squared", sql(_SIL2, "vecs"))
def silhouette_squared(spark, sf_dir):
    value = sg.silhouette(vectors(spark, sf_dir), "v", "label")
    out = spark.createDataFrame([(value,)], "silhouette double")
    return out.select(F.round("silhouette", 6).alias("silhouette"))


_CENTROID = """with item as (select vec_id, label, unnest(embedding::double[]) as x, generate_subscripts(embedding, 1) as i from embeddings),
mean as (select label, i, avg(x) as m, count(*) as size from item group by 1, 2),
apart as (select vec_id, t.label as own, m.label as l, sqrt(sum((x - m) ** 2)) as d, max(size) as size
  from item t join mean m using (i) group by 1, 2, 3),
nearest as (select vec_id, max(d) filter (where l = own) as a, min(d) filter (where l <> own) as b,
  max(size) filter (where l = own) as size from apart group by 1)
select round(avg(case when size = 1 or greatest(a, b) = 0 then 0 else (b - a) / greatest(a, b) end), 6) as silhouette from nearest"""


@query("silhouette_centroid", _CENTROID)
def silhouette_centroid(spark, sf_dir):
    value = sg.centroid_silhouette(vectors(spark, sf_dir), "v", "label")
    out = spark.createDataFrame([(value,)], "silhouette double")
    return out.select(F.round("silhouette", 6).alias("silhouette"))


_KS = (2, 3, 4, 5, 10)


@query(
    "best_k",
    sql(
        "select k, round(silhouette, 6) as silhouette from ("
        + " union all ".join(
            f"select {k} as k, ({_silhouette_sql('list_distance(p.v, q.v) ** 2', f'label % {k}')}) as silhouette"
            for k in _KS
        )
        + ") order by silhouette desc, k limit 1",
        "vecs",
    ),
)
def best_k(spark, sf_dir):
    v = stage_table(vectors(spark, sf_dir), "vectors")
    rows = [
        (k, sg.silhouette(v.withColumn("c", F.col("label") % k), "v", "c")) for k in _KS
    ]
    out = sg.best_k(spark.createDataFrame(rows, "k int, silhouette double"))
    return out.withColumn("silhouette", F.round("silhouette", 6))


# --- segments with fixed labels -----------------------------------------------

_define(
    "segment",
    ("labelled", "feat"),
    "select f.*, l.cluster, " + ", ".join(f"l.p_{p}" for p in DENSE)
    + " from feat f join labelled l using (household_key)",
)
_PROFILED = [*P.values(), *sg.PROFILE_COLUMNS]
_define(
    "profile",
    ("segment",),
    "select cluster, " + ", ".join(f"round(avg({c}), 4) as {c}" for c in _PROFILED)
    + ", count(*) as cluster_size from segment group by cluster",
)
_TOP = f"greatest({', '.join(P.values())})"
_TOP_NAME = "case " + " ".join(f"when {c} = {_TOP} then '{p}'" for p, c in P.items()) + " end"
_NAME = f"""case when product_count >= 2.5 then '{SEGMENT_LABELS["multi_product"]}'
  when total_ers_calls > 2 then '{SEGMENT_LABELS["heavy_use"]}' when income_mean > 100000 then '{SEGMENT_LABELS["high_income"]}'
  when member_tenure_years_mean > 15 then '{SEGMENT_LABELS["long_tenure"]}'
  when {_TOP} > 0.30 then {_TOP_NAME} || ' Aficionados' else 'General Segment ' || cluster end"""
_define(
    "action",
    ("profile",),
    f"""select cluster, {_NAME} as cluster_name, cluster_size,
  case when {_TOP} >= 0.27 then {_TOP_NAME} else '{NURTURE_LABEL}' end as recommended_product,
  round({_TOP}, 4) as avg_propensity, round(income_mean, 0) as avg_income,
  round(member_tenure_years_mean, 1) as avg_tenure_years, round(product_count, 2) as avg_product_count,
  round(has_used_ers, 3) as pct_ers_users from profile""",
)
_MIN = 0.27  # splits the fixed test segments into offers and nurture


def labelled(spark, sf_dir):
    """Household features with call shares; the segment is the largest share."""
    wide = shares(spark, sf_dir).select(K, *[F.col(f"calls_{p}").alias(c) for p, c in P.items()])
    top = F.greatest(*P.values())
    label = F.when(F.col(P[DENSE[0]]) == top, 0)
    for i, p in enumerate(DENSE[1:], 1):
        label = label.when(F.col(P[p]) == top, i)
    return features(spark, sf_dir).join(wide.withColumn("cluster", label), K)


def profile(spark, sf_dir):
    return sg.profile_clusters(labelled(spark, sf_dir), list(P.values()))


def actions(spark, sf_dir):
    return sg.action_table(profile(spark, sf_dir), P, _MIN)


@query("cluster_sizes", sql("select cluster, count(*) as cluster_size from labelled group by 1", "labelled"))
def cluster_sizes(spark, sf_dir):
    return sg.cluster_sizes(labelled(spark, sf_dir))


@query("cluster_profile", sql("select * from profile", "profile"))
def cluster_profile(spark, sf_dir):
    return profile(spark, sf_dir)


@query(
    "cluster_profile_norm",
    sql(
        """select cluster, feature, mean, round((mean - min(mean) over f) / coalesce(nullif(max(mean) over f - min(mean) over f, 0), 1), 6) as scaled
from (unpivot (select cluster, """
        + ", ".join(f"{c}::double as {c}" for c in _PROFILED)
        + f" from profile) on {', '.join(_PROFILED)} into name feature value mean) window f as (partition by feature)",
        "profile",
    ),
)
def cluster_profile_norm(spark, sf_dir):
    out = sg.normalised_profile(profile(spark, sf_dir), _PROFILED)
    return out.withColumn("scaled", F.round("scaled", 6))


@query("segment_names", sql("select cluster, cluster_name from action", "action"))
def segment_names(spark, sf_dir):
    return sg.name_segments(profile(spark, sf_dir), P).select("cluster", "cluster_name")


# The same rules over profiles of single households, so that every branch occurs.
_SINGLE = f"select household_key as cluster, {', '.join(_PROFILED)} from segment"


@query(
    "segment_names_by_household",
    sql(
        f"select cluster, {_NAME.replace('total_ers_calls > 2', 'total_ers_calls / 100 > 2')} as cluster_name from ({_SINGLE})",
        "segment",
    ),
)
def segment_names_by_household(spark, sf_dir):
    table = labelled(spark, sf_dir).drop("cluster").withColumnRenamed(K, "cluster")
    table = table.select("cluster", *_PROFILED)
    scaled = table.withColumn("total_ers_calls", F.col("total_ers_calls") / 100)
    return sg.name_segments(scaled, P).select("cluster", "cluster_name")


@query("action_table", sql("select * from action", "action"))
def action_table(spark, sf_dir):
    return actions(spark, sf_dir)


_RECOMMENDED = "select household_key, s.cluster, cluster_name, recommended_product from segment s left join action a on s.cluster = a.cluster"


def recommended(spark, sf_dir):
    table = stage_table(labelled(spark, sf_dir), "labelled")
    table_actions = sg.action_table(sg.profile_clusters(table, list(P.values())), P, _MIN)
    return rc.attach_recommendation(table, table_actions)


@query("attach_recommendation", sql(_RECOMMENDED, "segment", "action"))
def attach_recommendation(spark, sf_dir):
    return recommended(spark, sf_dir).select(K, "cluster", "cluster_name", "recommended_product")


@query(
    "recommendations",
    sql(
        "select household_key, cluster, recommended_product, total_cost_sum::double as total_cost_sum"
        f" from ({_RECOMMENDED.replace('household_key, s.cluster', 'household_key, total_cost_sum, s.cluster')})",
        "segment", "action",
    ),
)
def recommendations(spark, sf_dir):
    path = scratch_path(spark, "recommendations")
    io.write_parquet(recommended(spark, sf_dir), path, "recommended_product")
    return plain(io.scan_parquet(spark, path, [K, "cluster", "recommended_product", "total_cost_sum"]))


@query(
    "recommendation_distribution",
    sql(
        f"select recommended_product, count(*) as n, round(count(*) / sum(count(*)) over () * 100, 1) as share_pct from ({_RECOMMENDED}) group by 1",
        "segment", "action",
    ),
)
def recommendation_distribution(spark, sf_dir):
    return rc.recommendation_distribution(recommended(spark, sf_dir))


@query(
    "nurture_split",
    sql(
        f"select recommended_product = '{NURTURE_LABEL}' as is_nurture, count(*) as n, count(*) / sum(count(*)) over () as share from ({_RECOMMENDED}) group by 1",
        "segment", "action",
    ),
)
def nurture_split(spark, sf_dir):
    return rc.nurture_split(recommended(spark, sf_dir))


@query(
    "segments_by_tier",
    sql(
        "select cluster, cluster_name, recommended_product, avg_propensity,"
        " case when avg_propensity > 0.5 then 'highest' when avg_propensity > 0.25 then 'second wave' else 'nurture' end as tier from action"
        " where avg_propensity > 0.25 and avg_propensity <= 0.5",
        "action",
    ),
)
def segments_by_tier(spark, sf_dir):
    out = rc.segments_by_tier(actions(spark, sf_dir), "second wave")
    return out.select("cluster", "cluster_name", "recommended_product", "avg_propensity", "tier")


# --- offers per household -------------------------------------------------------


def offers(spark, sf_dir):
    return shares(spark, sf_dir).select(K, *[F.col(f"calls_{p}").alias(c) for p, c in P.items()])


@query(
    "argmax_product",
    sql(f"select household_key, {_TOP} as best_score, {_TOP_NAME} as best_product from offer", "offer"),
)
def argmax_product(spark, sf_dir):
    return sg.argmax_product(offers(spark, sf_dir), P).select(K, "best_score", "best_product")


@query(
    "household_top_offer",
    sql(
        f"""select household_key, product as top_product, p as top_score,
  case when p > 0.25 then product else '{NURTURE_LABEL}' end as offer
from score where model = 'calls' qualify row_number() over (partition by household_key order by p desc, product) = 1""",
        "score",
    ),
)
def household_top_offer(spark, sf_dir):
    return rc.household_top_offer(offers(spark, sf_dir), K, P, 0.25)


@query(
    "household_scores",
    sql(
        """select household_key, row_number() over (partition by household_key order by p desc, product)::int as place, product,
  p as score, case when p > 0.5 then 'high' when p > 0.25 then 'medium' else 'low' end as tier from score where model = 'calls'""",
        "score",
    ),
)
def household_scores(spark, sf_dir):
    return rc.household_scores(offers(spark, sf_dir), K, P)
