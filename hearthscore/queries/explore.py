"""Audit and exploration queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthscore.config import (
    FLAG_SUFFIX,
    INCOME_MIDPOINTS,
    MEMBER_COLUMNS,
    MODE_COLUMNS,
    Settings,
)
from hearthscore.operators import clean
from hearthscore.operators import explore as ex
from hearthscore.operators import lookup as lk
from hearthscore.operators import members as mb
from hearthscore.queries.catalog import calls, features, households, plain, query
from hearthscore.queries.households import FEATURES, K
from hearthscore.queries.oracle_base import _case, sql, yn
from hearthscore.session import stage_table
from hearthscore.sources import tpch_calls as src

_RAW = [
    *[p + FLAG_SUFFIX for p in src.PRODUCTS], *MEMBER_COLUMNS, "cancel_reason"
]
_NUMERIC = [c for c in FEATURES if c not in (K, *MODE_COLUMNS)]
_DENSE = list(src.DENSE_PRODUCTS)


def first_rows(spark, sf_dir):
    """One raw row per member, any status."""
    return mb.dedup_first(calls(spark, sf_dir))


_MISSING = (
    "select column_name, n - filled as missing_count,"
    " round(100.0::double * (n - filled) / n, 2) as missing_pct from (select count(*) as n from member0) cross join ("
    + " union all ".join(f"select '{c}' as column_name, count({c}) as filled from member0" for c in _RAW)
    + ") where n > filled"
)


@query("audit_missing", sql(_MISSING, "member0"))
def audit_missing(spark, sf_dir):
    return ex.audit_missing(first_rows(spark, sf_dir).drop(clean.ORDER_COLUMN))


@query("top_missing", sql(_MISSING + " order by missing_pct desc, column_name limit 25", "member0"))
def top_missing(spark, sf_dir):
    return ex.top_missing(first_rows(spark, sf_dir).drop(clean.ORDER_COLUMN))


@query(
    "grain_report",
    sql(
        "select count(*) as n_rows, count(distinct member_key) as n_members,"
        f" count(distinct household_key) as n_households, {len(_RAW)} as n_columns from raw",
        "raw",
    ),
)
def grain_report(spark, sf_dir):
    return ex.grain_report(calls(spark, sf_dir).drop(clean.ORDER_COLUMN))


def _describe(column: str, table: str, label: str | None = None) -> str:
    x = f"{column}::double"
    return f"""select '{label or column}' as column_name, count({column}) as n, round(avg({x}), 4) as mean,
  round(stddev_samp({x}), 4) as std, min({x}) as min, max({x}) as max,
  round(quantile_cont({x}, 0.25), 6) as q25, round(quantile_cont({x}, 0.5), 6) as q50,
  round(quantile_cont({x}, 0.75), 6) as q75 from {table}"""


def _rounded(df):
    four = {c: F.round(c, 4) for c in ("mean", "std")}
    return df.withColumns({**four, **{c: F.round(c, 6) for c in ("q25", "q50", "q75")}})


@query(
    "rows_per_member",
    sql(_describe("rows", "(select count(*) as rows from raw group by member_key)"), "raw"),
)
def rows_per_member(spark, sf_dir):
    return _rounded(ex.rows_per_member(calls(spark, sf_dir)))


_DESCRIBED = ["total_cost", "member_tenure_years", "length_of_residence", "ers_member_cost_year_1"]


@query(
    "describe",
    sql(" union all ".join(_describe(c, "raw where total_cost > 0") for c in _DESCRIBED), "raw"),
)
def describe(spark, sf_dir):
    return _rounded(ex.describe(ex.cost_nonzero(calls(spark, sf_dir)), _DESCRIBED))


@query(
    "status_distribution",
    sql(
        "select member_status, count(*) as n, count(*) / sum(count(*)) over () as share"
        " from member0 group by 1",
        "member0",
    ),
)
def status_distribution(spark, sf_dir):
    return ex.status_distribution(first_rows(spark, sf_dir))


_HOLD = "hold as (select household_key, " + ", ".join(
    f"max({yn(p + FLAG_SUFFIX)}) as {p}" for p in src.PRODUCTS
) + " from member0 group by 1)"


def _with_hold(final: str) -> str:
    return sql(final, "member0").replace("\n" + final, f", {_HOLD}\n{final}")


@query(
    "adoption_household",
    _with_hold(
        " union all ".join(
            f"select '{p}' as product, avg({p}) as penetration, sum({p})::bigint as positives from hold"
            for p in src.PRODUCTS
        )
    ),
)
def adoption_household(spark, sf_dir):
    return ex.product_rates(ex.household_holdings(first_rows(spark, sf_dir)), src.PRODUCTS)


_DEPTH = f"""select depth, households, households / sum(households) over () as share,
  sum(households) over (order by depth) / sum(households) over () as cumulative
from (select ({" + ".join(src.PRODUCTS)})::int as depth, count(*) as households from hold group by 1)"""


@query("product_depth", _with_hold(f"select depth, households, share from ({_DEPTH})"))
def product_depth(spark, sf_dir):
    held = ex.household_holdings(first_rows(spark, sf_dir))
    return ex.product_depth(held, src.PRODUCTS).drop("cumulative")


@query("product_depth_cumulative", _with_hold(f"select depth, cumulative from ({_DEPTH})"))
def product_depth_cumulative(spark, sf_dir):
    held = ex.household_holdings(first_rows(spark, sf_dir))
    return ex.product_depth(held, src.PRODUCTS).select("depth", "cumulative")


@query(
    "product_depth_summary",
    _with_hold(
        "select sum((d = 0)::int)::double / count(*) as no_product, sum((d >= 2)::int)::double / count(*)"
        f" as two_or_more from (select {' + '.join(src.PRODUCTS)} as d from hold)"
    ),
)
def product_depth_summary(spark, sf_dir):
    held = ex.household_holdings(first_rows(spark, sf_dir))
    return ex.depth_summary(ex.product_depth(held, src.PRODUCTS))


@query(
    "adoption_by_usage",
    sql(
        " union all ".join(
            f"select (sc_date is not null)::int as has_used_ers, '{p}' as product,"
            f" avg({yn(p + FLAG_SUFFIX)}) as rate from member0 group by 1"
            for p in src.PRODUCTS
        ),
        "member0",
    ),
)
def adoption_by_usage(spark, sf_dir):
    return ex.adoption_by_usage(first_rows(spark, sf_dir))


_BOX = " union all ".join(
    f"select '{p}' as product, {yn(p + FLAG_SUFFIX)} as buyer, {_case('income', INCOME_MIDPOINTS)} as income from member0"
    for p in src.PRODUCTS
)


@query(
    "income_by_buyer",
    sql(
        f"""select x.product, x.buyer, members, q1, median, q3,
  min(income) filter (where income between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as whisker_low,
  max(income) filter (where income between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)) as whisker_high,
  count(*) filter (where not (income between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))) as outliers
from (select * from ({_BOX}) where income is not null) x join (
  select product, buyer, count(*) as members, quantile_cont(income, 0.25) as q1, quantile_cont(income, 0.5) as median,
    quantile_cont(income, 0.75) as q3 from ({_BOX}) where income is not null group by 1, 2) b
  on x.product = b.product and x.buyer = b.buyer
group by all""",
        "member0",
    ),
)
def income_by_buyer(spark, sf_dir):
    return ex.income_by_buyer(first_rows(spark, sf_dir), INCOME_MIDPOINTS)


@query(
    "cost_nonzero",
    sql(
        "select member_key, household_key, total_cost::double as total_cost from raw"
        " where total_cost > 0",
        "raw",
    ),
)
def cost_nonzero(spark, sf_dir):
    raw = calls(spark, sf_dir).select("member_key", "household_key", "total_cost")
    return plain(ex.cost_nonzero(raw))


def histogram_sql(expr: str, table: str, bins: int, where: str = "true") -> str:
    return f"""select bin, round(lo + bin * ((hi - lo) / {bins}), 6) as low, coalesce(n, 0) as n
from (select unnest(range({bins})) as bin)
cross join (select min({expr}) as lo, max({expr}) as hi from {table} where {where})
left join (select least(floor(({expr} - lo) / (hi - lo) * {bins}), {bins - 1})::bigint as bin, count(*) as n
  from {table} cross join (select min({expr}) as lo, max({expr}) as hi from {table} where {where})
  where {where} group by 1) using (bin)"""


@query(
    "cost_histogram",
    sql(
        f"select *, 'raw' as scale from ({histogram_sql('total_cost::double', 'raw', 60, 'total_cost > 0')})"
        f" union all select *, 'log1p' as scale from ("
        f"{histogram_sql('ln(1 + total_cost::double)', 'raw', 60, 'total_cost > 0')})",
        "raw",
    ),
)
def cost_histogram(spark, sf_dir):
    return ex.cost_histogram(calls(spark, sf_dir)).withColumn("low", F.round("low", 6))


@query(
    "zero_inflation",
    sql(
        """select count(*) as members, avg((every = 0)::int) as zero_share, avg((dated = 0)::int) as zero_share_dated
from (select member_key, sum(total_cost) as every,
  coalesce(sum(total_cost) filter (where sc_date is not null), 0) as dated from raw group by 1)""",
        "raw",
    ),
)
def zero_inflation(spark, sf_dir):
    return ex.zero_inflation(calls(spark, sf_dir))


@query(
    "cost_profile",
    sql(
        """select count(*) as n, avg((total_cost = 0)::int) as zero_share,
  (sum(total_cost) filter (where total_cost > 0))::double / count(*) filter (where total_cost > 0) as mean_nonzero,
  round(median(total_cost::double) filter (where total_cost > 0), 6) as median_nonzero from cost""",
        "cost",
    ),
)
def cost_profile(spark, sf_dir):
    costs = mb.cost_pivot(calls(spark, sf_dir, grouped=True), src.COST_YEARS).select("total_cost")
    out = ex.cost_profile(stage_table(costs, "costs"), "total_cost")
    return out.withColumn("median_nonzero", F.round("median_nonzero", 6))


@query(
    "product_penetration",
    sql(
        " union all ".join(
            f"select '{p}' as product, avg({p}) as penetration, sum({p})::bigint as positives from hh"
            for p in src.PRODUCTS
        ),
        "hh",
    ),
)
def product_penetration(spark, sf_dir):
    return ex.product_rates(households(spark, sf_dir), src.PRODUCTS)


@query(
    "modelable_products",
    sql(
        "select * from ("
        + " union all ".join(
            f"select '{p}' as product, avg({p}) as penetration, sum({p})::bigint as positives from hh"
            for p in src.PRODUCTS
        )
        + ") where penetration >= 0.05 and positives >= 20",
        "hh",
    ),
)
def modelable_products(spark, sf_dir):
    return ex.modelable_products(households(spark, sf_dir), src.PRODUCTS, Settings())


_LONG = "unpivot (select household_key as hk, {cols} from feat) on {names} into name c value x"
_LONG = _LONG.format(
    cols=", ".join(f"{c}::double as {c}" for c in _NUMERIC), names=", ".join(_NUMERIC)
)


@query(
    "correlation_matrix",
    sql(
        """, top as (select c, row_number() over (order by var_samp(x) desc, c) as place from long group by c
  qualify place <= 20)
select a.c as feature_a, b.c as feature_b, round(corr(a.x, b.x), 6) as corr
from long a join long b using (hk) join top ta on a.c = ta.c join top tb on b.c = tb.c
where ta.place > tb.place group by 1, 2""",
        "feat",
        extra={"long": _LONG},
    ).replace(")\n, top", "), top"),
)
def correlation_matrix(spark, sf_dir):
    out = ex.correlation_matrix(features(spark, sf_dir), _NUMERIC)
    return out.withColumn("corr", F.round("corr", 6))


@query(
    "target_correlation",
    sql(
        """select feature, round(abs(r), 6) as abs_corr, abs(r) > 0.7 as suspicious from (
  select c as feature, case when var_pop(x) > 0 then corr(x, economy) end as r
  from long join feat on hk = household_key where c <> 'economy' group by 1)
where r is not null order by abs(r) desc, feature limit 20""",
        "feat",
        extra={"long": _LONG},
    ),
)
def target_correlation(spark, sf_dir):
    out = ex.target_correlation(features(spark, sf_dir), _NUMERIC, "economy")
    return out.withColumn("abs_corr", F.round("abs_corr", 6))


@query("household_keys", sql("select household_key from hh order by household_key limit 500", "hh"))
def household_keys(spark, sf_dir):
    return lk.household_keys(households(spark, sf_dir))


@query(
    "random_household",
    sql(
        "select household_key from hh order by ('0x' || substr(md5(household_key || '-7'), 1, 15))::bigint limit 1",
        "hh",
    ),
)
def random_household(spark, sf_dir):
    return lk.random_household(households(spark, sf_dir), 7)


@query(
    "household_lookup",
    sql(
        f"select {', '.join(c if 'cost' not in c or c.endswith('_mean') or c == 'avg_cost_per_call' else c + '::double as ' + c for c in FEATURES)}"
        " from feat where household_key in (select c_custkey from customer where c_acctbal < 0)",
        "feat",
    ),
)
def household_lookup(spark, sf_dir):
    asked = src.table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    asked = asked.select(F.col("c_custkey").alias(K))
    return plain(lk.find_households(features(spark, sf_dir).select(*FEATURES), asked))
