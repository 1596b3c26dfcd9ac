"""Building blocks of the DuckDB statements that check the Spark queries.

Written independently of the operators: plain SQL over the same Parquet tables,
in the longer textbook form (windows, pivots, separate joins).
"""

from __future__ import annotations

from hearthscore.config import (
    CALL_COLUMNS,
    CHILDREN_COUNTS,
    CREDIT_MIDPOINTS,
    INCOME_MIDPOINTS,
    MEAN_COLUMNS,
    MEMBER_COLUMNS,
    MODE_COLUMNS,
)
from hearthscore.sources.tpch_calls import COST_YEARS, DENSE_PRODUCTS, PRODUCTS, TYPES


def _list(labels) -> str:
    return "[" + ", ".join(f"'{x}'" for x in labels) + "]"


def _case(column: str, table: dict) -> str:
    whens = " ".join(f"when '{k}' then {v}" for k, v in table.items())
    return f"cast(case {column} {whens} end as double)"


def _sum_join(parts, glue=", ") -> str:
    return glue.join(parts)


_FLAGS = [
    f"case when p_type = '{t}' and l_quantity >= 48 and l_returnflag = 'R' then 'Y' else 'N' end"
    f" as {t.lower()}_flag"
    for t in TYPES
] + [
    f"case when p_size = 50 and l_quantity = 50 and l_returnflag = '{x}' then 'Y' else 'N' end"
    f" as sparse_{x.lower()}_flag"
    for x in "RAN"
]
_YEARS = [
    f"""case when year(l_shipdate) = {1998 + i} then l_quantity else 0.0::double end as ers_ent_count_year_{i},
  case when year(l_shipdate) = {1998 + i} then l_extendedprice::decimal(18,2) else 0::decimal(18,2) end as ers_member_cost_year_{i}"""
    for i in (1, 2, 3)
]

CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def _define(name: str, needs: tuple[str, ...], sql: str) -> None:
    CTE[name] = (needs, sql)


_define(
    "raw",
    (),
    f"""select l_orderkey || '-' || l_linenumber as member_key, o_custkey as household_key,
  case when not (l_linenumber = 7 and l_returnflag = 'N') then l_shipdate end as sc_date,
  l_extendedprice::decimal(18,2) as total_cost,
  case o_orderstatus when 'F' then 'ACTIVE' when 'P' then 'PENDING' else 'CANCELLED' end as member_status,
  case when o_orderstatus = 'O' then 'moved' end as cancel_reason,
  case when l_linenumber = 1 then 'Primary' else 'Associate' end as member_type,
  {_sum_join(_FLAGS)},
  case when c_acctbal < 0 then 'Unknown'
       else ({_list(list(INCOME_MIDPOINTS)[:10])})[least(floor(c_acctbal / 1000), 9)::int + 1] end as income,
  ({_list([*CREDIT_MIDPOINTS, "Unknown"])})[c_nationkey % 9 + 1] as credit_ranges,
  ({_list([*CHILDREN_COUNTS, "Seven Children"])})[(l_orderkey % 8 + 1)::int] as number_of_children,
  p_brand as zip,
  case when p_size > 5 then c_mktsegment end as home_owner,
  p_type as dwelling_type, o_orderpriority as mosaic_household,
  l_returnflag as mosaic_global_household, l_linestatus as kcl_b_ind_mosaicsgrouping,
  (2 * (2002 - year(o_orderdate)))::double as member_tenure_years,
  case when p_size < 45 then p_size::double end as length_of_residence,
  {_sum_join(_YEARS)},
  (['Yes', 'No', 'Y', 'N', '?'])[(l_suppkey % 5 + 1)::int] as mail_responder,
  (['Y', 'N', 'Maybe'])[(l_partkey % 3 + 1)::int] as email_available,
  (['0', '1', '0', 'n/a'])[(l_suppkey % 4 + 1)::int] as do_not_direct_mail_solicit,
  l_shipdate as o1, l_partkey as o2, l_suppkey as o3
from lineitem join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey join part on l_partkey = p_partkey""",
)

_FIRST = "row_number() over (partition by member_key order by o1, o2, o3) = 1"
_define("member0", ("raw",), f"select * from raw qualify {_FIRST}")

_YEAR_OR_ZERO = "coalesce(year(sc_date), 0)"
_define(
    "cost",
    ("raw",),
    "select member_key, "
    + ", ".join(
        f"coalesce(sum(total_cost) filter (where year(sc_date) = {y}), 0) as cost_{y}"
        for y in COST_YEARS
    )
    + f", coalesce(sum(total_cost) filter (where {_YEAR_OR_ZERO} > 0), 0) as total_cost"
    + " from raw group by member_key",
)

YES_NO_SQL = "case {c} when 'Y' then 1 when 'N' then 0 when 'Yes' then 1 when 'No' then 0 end"


def yn(column: str) -> str:
    return YES_NO_SQL.format(c=column)


_ENCODED_COLUMNS = [
    "income", "credit_ranges", "number_of_children", "mail_responder", "email_available",
    "do_not_direct_mail_solicit",
]
_PLAIN = [
    c
    for c in MEMBER_COLUMNS
    if c not in (*_ENCODED_COLUMNS, "member_status", "member_type", "sc_date", "total_cost")
]
ENCODED = f"""{", ".join(_PLAIN)},
  {_case("income", INCOME_MIDPOINTS)} as income,
  {_case("credit_ranges", CREDIT_MIDPOINTS)} as credit_ranges,
  {_case("number_of_children", CHILDREN_COUNTS)} as number_of_children,
  {yn("mail_responder")} as mail_responder, {yn("email_available")} as email_available,
  try_cast(do_not_direct_mail_solicit as double) as do_not_direct_mail_solicit,
  (member_type = 'Primary')::int as primary_member, (member_type = 'Associate')::int as associate_member,
  {", ".join(f"{yn(p + '_flag')} as {p}" for p in PRODUCTS)}"""

_define(
    "kept",
    ("raw",),
    f"select * from raw where member_status in ('ACTIVE', 'PENDING') qualify {_FIRST}",
)
_define(
    "member",
    ("kept", "cost"),
    f"select e.*, {', '.join(f'coalesce(c.cost_{y}, 0) as cost_{y}' for y in COST_YEARS)},"
    " coalesce(c.total_cost, 0) as total_cost"
    f" from (select {ENCODED} from kept) e left join cost c on e.member_key = c.member_key",
)


def _mode_cte(c: str) -> str:
    return f"""(select household_key, v as {c} from (
    select household_key, coalesce({c}, 'Not Set') as v, count(*) as n from member
    group by 1, 2) qualify row_number() over (partition by household_key order by n desc, v) = 1)"""


MEANS = ", ".join(
    f"sum({c})::double / nullif(count({c}), 0) as {c}_mean" for c in MEAN_COLUMNS
)
CALLS = ", ".join(
    f"coalesce(sum({c}), 0) as {c}_sum, sum({c})::double / nullif(count({c}), 0) as {c}_mean"
    for c in CALL_COLUMNS
)
COSTS = ", ".join(
    f"coalesce(sum({c}), 0) as {c}_sum" for c in [*(f"cost_{y}" for y in COST_YEARS), "total_cost"]
)
MAXES = ", ".join(f"max({p}) as {p}" for p in PRODUCTS)
_define("hh_mode", ("member",), "select * from " + " join ".join(
    f"{_mode_cte(c)} m{i}" + ("" if i == 0 else " using (household_key)")
    for i, c in enumerate(MODE_COLUMNS)
))
_define(
    "hh",
    ("member", "hh_mode"),
    f"""select * from hh_mode join (
  select household_key, count(*) as members, {MEANS}, {CALLS}, {COSTS}, {MAXES}
  from member group by household_key) n using (household_key)""",
)
_define("q75", ("hh",), "select quantile_cont(income_mean, 0.75) as q75 from hh")
_define(
    "feat",
    ("hh", "q75"),
    f"""select *, (product_count >= 2)::int as is_multi_product, (total_ers_calls > 0)::int as has_used_ers,
  total_cost_sum::double / (total_ers_calls + 0.001::double) as avg_cost_per_call,
  coalesce((member_tenure_years_mean >= 10)::int, 0) as is_long_term_member,
  cost_{COST_YEARS[-1]}_sum - cost_{COST_YEARS[0]}_sum as cost_trend,
  coalesce((income_mean >= (select q75 from q75))::int, 0) as is_high_income
from (select *, ers_ent_count_year_1_sum + ers_ent_count_year_2_sum + ers_ent_count_year_3_sum as total_ers_calls,
  ({" + ".join(f"coalesce({p}, 0)" for p in PRODUCTS)})::int as product_count from hh)""",
)
# Deterministic scores: the share of a household's calls and costs that concern
# a product's dwelling type.
_define(
    "share",
    ("raw",),
    f"""select household_key, product,
  (count(*) filter (where lower(dwelling_type) = product))::double / count(*) as calls,
  coalesce(sum(total_cost) filter (where lower(dwelling_type) = product), 0)::double / sum(total_cost)::double as cost
from raw cross join (select unnest({_list(DENSE_PRODUCTS)}) as product)
where member_status in ('ACTIVE', 'PENDING') group by 1, 2""",
)
_define(
    "score",
    ("share", "hh"),
    """select s.household_key, s.product, m.model,
  case s.product """
    + " ".join(f"when '{p}' then h.{p}" for p in DENSE_PRODUCTS)
    + """ end as y, case m.model when 'calls' then s.calls else s.cost end as p
from share s join hh h on s.household_key = h.household_key
  cross join (select unnest(['calls', 'cost']) as model) m""",
)
_define(
    "offer",
    ("score",),
    "select household_key, "
    + ", ".join(f"max(p) filter (where product = '{p}') as p_{p}" for p in DENSE_PRODUCTS)
    + " from score where model = 'calls' group by household_key",
)
_define(
    "labelled",
    ("offer",),
    "select *, case "
    + " ".join(
        f"when p_{p} = greatest({', '.join('p_' + q for q in DENSE_PRODUCTS)}) then {i}"
        for i, p in enumerate(DENSE_PRODUCTS)
    )
    + " end as cluster from offer",
)
_define(
    "doc_score",
    (),
    "select doc_id as key, quality as y, (n_chars % 1000) / 1000.0::double as p"
    " from labels join documents using (doc_id)",
)
_define(
    "pred",
    (),
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice as y,"
    " l_quantity * p_retailprice as yhat from lineitem join part on l_partkey = p_partkey",
)
_define("vecs", (), "select vec_id, embedding::double[] as v, label from embeddings")


def sql(final: str, *needs: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` chain for the named blocks, in dependency order, plus ``final``."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for n in CTE[name][0]:
            visit(n)
        order.append(name)

    for n in needs:
        visit(n)
    parts = [f"{n} as materialized ({CTE[n][1]})" for n in order]
    parts += [f"{n} as ({body})" for n, body in (extra or {}).items()]
    return f"with {', '.join(parts)}\n{final}" if parts else final
