"""Scans, sinks, cleaning and member-level queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthscore.config import EXCLUDED, FLAG_SUFFIX, MEMBER_COLUMNS
from hearthscore.functions.encode import call_time, number, slug
from hearthscore.operators import clean
from hearthscore.operators import members as mb
from hearthscore.queries.catalog import calls, plain, query
from hearthscore.queries.oracle_base import ENCODED, sql
from hearthscore.session import scratch_path
from hearthscore.sources import calls as io
from hearthscore.sources import tpch_calls as src

_FLAGS = [p + FLAG_SUFFIX for p in src.PRODUCTS]
_MONEY = ["total_cost", *(f"ers_member_cost_year_{i}" for i in (1, 2, 3))]
_DAY = "strftime(sc_date, '%Y-%m-%d') as sc_date"


def _raw_list(columns) -> str:
    out = []
    for c in columns:
        if c in _MONEY:
            out.append(f"{c}::double as {c}")
        elif c == "sc_date":
            out.append(_DAY)
        else:
            out.append(c)
    return ", ".join(out)


@query(
    "scan_csv",
    sql(f"select {_raw_list([*_FLAGS, *MEMBER_COLUMNS, 'cancel_reason'])} from raw", "raw"),
)
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "calls-csv")
    io.write_csv(calls(spark, sf_dir).drop("file_order"), path, compressed=True)
    return plain(io.scan_csv(spark, path).select(*_FLAGS, *MEMBER_COLUMNS, "cancel_reason"))


@query(
    "scan_csv_multiline",
    sql(
        "select member_key, household_key, total_cost::double as total_cost,"
        " member_key || chr(10) || '\"' || coalesce(zip, '') || '\",' || chr(10) as note from raw",
        "raw",
    ),
)
def scan_csv_multiline(spark, sf_dir):
    """Every record has a value of several lines with quotes and commas."""
    note = F.concat("member_key", F.lit('\n"'), F.coalesce("zip", F.lit("")), F.lit('",\n'))
    path = scratch_path(spark, "notes-csv")
    columns = ["member_key", "household_key", "total_cost", note.alias("note")]
    io.write_csv(calls(spark, sf_dir).select(*columns), path)
    return plain(io.scan_csv(spark, path, file_order=False))


@query(
    "csv_unparsable",
    sql(
        "select 'household_key' as column_name,"
        " count(household_key) filter (where zip like '%7') as unparsable from raw union all"
        " select 'total_cost', count(*) filter (where member_status = 'CANCELLED') from raw",
        "raw",
    ),
)
def csv_unparsable(spark, sf_dir):
    """Keys of some ZIP codes and costs of cancelled members are made unreadable."""
    key = F.when(F.col("zip").like("%7"), F.concat(F.lit("x"), "household_key")).otherwise(
        F.col("household_key").cast("string")
    )
    cost = F.when(F.col("member_status") == "CANCELLED", "n/a").otherwise(
        F.col("total_cost").cast("string")
    )
    path = scratch_path(spark, "spoiled-csv")
    io.write_csv(calls(spark, sf_dir).select(key.alias("household_key"), cost.alias("total_cost")), path)
    return io.unparsable(spark, path)


@query(
    "scan_parquet",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders"
    " where o_orderstatus in ('F', 'P') and o_totalprice > 1000",
)
def scan_parquet(spark, sf_dir):
    return io.scan_parquet(
        spark,
        f"{sf_dir}/orders.parquet",
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"],
        F.col("o_orderstatus").isin("F", "P") & (F.col("o_totalprice") > 1000),
    )


@query("select_whitelist", sql(f"select {_raw_list([*_FLAGS, *MEMBER_COLUMNS])} from raw", "raw"))
def select_whitelist(spark, sf_dir):
    return plain(clean.select_whitelist(calls(spark, sf_dir)))


_REST = [c for c in MEMBER_COLUMNS if c != "member_status"]


@query(
    "filter_status",
    sql(
        f"select {_raw_list([*_FLAGS, *_REST])} from raw where member_status in ('ACTIVE', 'PENDING')",
        "raw",
    ),
)
def filter_status(spark, sf_dir):
    return plain(clean.filter_status(clean.select_whitelist(calls(spark, sf_dir))))


@query(
    "exclusion_audit",
    sql(
        " union all ".join(
            f"select '{c}' as column_name, {int(c == 'cancel_reason')} as present, "
            + ("(select count(cancel_reason) from raw)" if c == "cancel_reason" else "0::bigint")
            + " as filled"
            for c in EXCLUDED
        ),
        "raw",
    ),
)
def exclusion_audit(spark, sf_dir):
    return clean.exclusion_audit(calls(spark, sf_dir))


@query("encode_ordinals", sql(
    f"select {_raw_list(['member_key', 'household_key', 'sc_date', 'total_cost'])}, income, credit_ranges,"
    f" number_of_children from (select member_key, household_key, sc_date, total_cost,"
    f" {ENCODED[ENCODED.index('cast(case income'):ENCODED.index('case mail_responder')].rstrip().rstrip(',')} from raw)",
    "raw"))
def encode_ordinals(spark, sf_dir):
    out = clean.encode_ordinals(calls(spark, sf_dir))
    return plain(out.select("member_key", "household_key", "sc_date", "total_cost", "income",
                            "credit_ranges", "number_of_children"))


_FLAG_OUT = ["mail_responder", "email_available", "primary_member", "associate_member"]


@query(
    "encode_flags",
    sql(
        f"select member_key, total_cost::double as total_cost, {', '.join([*src.PRODUCTS, *_FLAG_OUT])}"
        f" from (select {ENCODED}, total_cost from raw)",
        "raw",
    ),
)
def encode_flags(spark, sf_dir):
    out = clean.encode_flags(calls(spark, sf_dir))
    return plain(out.select("member_key", "total_cost", *src.PRODUCTS, *_FLAG_OUT))


@query(
    "coerce_numeric",
    sql(
        "select do_not_direct_mail_solicit as given, try_cast(do_not_direct_mail_solicit as double)"
        " as parsed, count(*) as n from raw group by 1, 2",
        "raw",
    ),
)
def coerce_numeric(spark, sf_dir):
    return (
        calls(spark, sf_dir)
        .select(
            F.col("do_not_direct_mail_solicit").alias("given"),
            number("do_not_direct_mail_solicit").alias("parsed"),
        )
        .groupBy("given", "parsed")
        .agg(F.count(F.lit(1)).alias("n"))
    )


_DATE_TEXT = "case when l_linenumber = 7 and l_returnflag = 'N' then 'not a date' else strftime(l_shipdate, '%Y-%m-%d') end"


@query(
    "parse_call_date",
    f"""select given, strftime(try_cast(given as timestamp), '%Y-%m-%d') as parsed,
    coalesce(year(try_cast(given as timestamp)), 0)::int as call_year, count(*) as n
    from (select {_DATE_TEXT} as given from lineitem) group by all""",
)
def parse_call_date(spark, sf_dir):
    line = src.table(spark, sf_dir, "lineitem")
    bad = (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "N")
    text = F.when(bad, "not a date").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    parsed = line.select(text.alias("given")).withColumn("parsed", call_time("given"))
    return plain(
        parsed.withColumn("call_year", F.coalesce(F.year("parsed"), F.lit(0)))
        .groupBy("given", "parsed", "call_year")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "product_slug",
    """select label, replace(lower(regexp_replace(label, ' Flag$', '')), ' ', '_') as slug, n
    from (select p_type || ' ' || p_name || ' Flag' as label, count(*) as n from part group by 1)""",
)
def product_slug(spark, sf_dir):
    part = src.table(spark, sf_dir, "part")
    label = F.concat(F.col("p_type"), F.lit(" "), F.col("p_name"), F.lit(" Flag"))
    return (
        part.groupBy(label.alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("label", slug("label").alias("slug"), "n")
    )


@query(
    "unmapped_values",
    sql(
        """select 'income' as column_name, count(*) filter (where income = 'Unknown') as unmapped from raw
  union all select 'credit_ranges', count(*) filter (where credit_ranges = 'Unknown') from raw
  union all select 'number_of_children', count(*) filter (where number_of_children = 'Seven Children') from raw""",
        "raw",
    ),
)
def unmapped_values(spark, sf_dir):
    return clean.unmapped_values(calls(spark, sf_dir))


@query(
    "cost_by_year",
    sql(
        "select member_key, coalesce(year(sc_date), 0)::int as call_year,"
        " sum(total_cost)::double as cost from raw group by 1, 2",
        "raw",
    ),
)
def cost_by_year(spark, sf_dir):
    return plain(mb.cost_by_year(calls(spark, sf_dir)))


_COST_LIST = ", ".join(f"cost_{y}::double as cost_{y}" for y in src.COST_YEARS)
_COST_LIST += ", total_cost::double as total_cost"


@query("cost_pivot", sql(f"select member_key, {_COST_LIST} from cost", "cost"))
def cost_pivot(spark, sf_dir):
    return plain(mb.cost_pivot(calls(spark, sf_dir, grouped=True), src.COST_YEARS))


@query(
    "dedup_first",
    sql(
        f"select {_raw_list([*_FLAGS, *MEMBER_COLUMNS])} from member0",
        "member0",
    ),
)
def dedup_first(spark, sf_dir):
    return plain(mb.dedup_first(clean.select_whitelist(calls(spark, sf_dir))))


@query(
    "member_costs",
    sql(f"select member_key, household_key, {_COST_LIST} from member", "member"),
)
def member_costs(spark, sf_dir):
    raw = calls(spark, sf_dir)
    first = mb.dedup_first(clean.filter_status(clean.select_whitelist(raw)))
    joined = mb.member_costs(first, mb.cost_pivot(raw, src.COST_YEARS))
    names = [f"cost_{y}" for y in src.COST_YEARS]
    return plain(joined.select("member_key", "household_key", *names, "total_cost"))


_ENC_OUT = [
    c for c in MEMBER_COLUMNS if c not in ("member_status", "member_type", "sc_date", "total_cost")
]


@query(
    "encoded_members",
    sql(
        f"select {_raw_list(_ENC_OUT)}, {', '.join(src.PRODUCTS)}, primary_member, associate_member,"
        f" {_COST_LIST} from member",
        "member",
    ),
)
def encoded_members(spark, sf_dir):
    out = mb.encoded_members(calls(spark, sf_dir, grouped=True), src.COST_YEARS)
    names = [f"cost_{y}" for y in src.COST_YEARS]
    return plain(
        out.select(*_ENC_OUT, *src.PRODUCTS, "primary_member", "associate_member", *names, "total_cost")
    )
