"""Household roll-up, features and matrix queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearthscore.config import CALL_COLUMNS, MEAN_COLUMNS, MODE_COLUMNS
from hearthscore.operators import clean
from hearthscore.operators import features as ft
from hearthscore.operators import household as hh
from hearthscore.queries.catalog import features, households, members, plain, query
from hearthscore.queries.oracle_base import sql
from hearthscore.session import scratch_path
from hearthscore.sources import calls as io
from hearthscore.sources import tpch_calls as src

K = "household_key"
_COSTS = [*(f"cost_{y}_sum" for y in src.COST_YEARS), "total_cost_sum"]
_MEANS = [f"{c}_mean" for c in MEAN_COLUMNS]
_CALLS = [f"{c}_{s}" for c in CALL_COLUMNS for s in ("sum", "mean")]
_MONEY = {*_COSTS, "cost_trend", *(c for c in _CALLS if "cost" in c and c.endswith("_sum"))}
_DERIVED = [
    "total_ers_calls",
    "product_count",
    "is_multi_product",
    "has_used_ers",
    "avg_cost_per_call",
    "is_long_term_member",
    "cost_trend",
    "is_high_income",
]
HOUSEHOLD = [K, *MODE_COLUMNS, "members", *_MEANS, *_CALLS, *_COSTS, *src.PRODUCTS]
FEATURES = [*HOUSEHOLD, *_DERIVED]


def columns(names) -> str:
    return ", ".join(f"{c}::double as {c}" if c in _MONEY else c for c in names)


@query("household_mode", sql("select * from hh_mode", "hh_mode"))
def household_mode(spark, sf_dir):
    return hh.household_mode(members(spark, sf_dir))


@query("household_mean", sql(f"select {columns([K, *_MEANS])} from hh", "hh"))
def household_mean(spark, sf_dir):
    return hh.household_mean(members(spark, sf_dir))


@query("household_calls", sql(f"select {columns([K, *_CALLS])} from hh", "hh"))
def household_calls(spark, sf_dir):
    return plain(hh.household_calls(members(spark, sf_dir)))


@query("household_cost", sql(f"select {columns([K, *_COSTS])} from hh", "hh"))
def household_cost(spark, sf_dir):
    return plain(hh.household_cost(members(spark, sf_dir)))


@query("household_size", sql("select household_key, members from hh", "hh"))
def household_size(spark, sf_dir):
    return hh.household_size(members(spark, sf_dir))


@query("household_flags", sql(f"select {columns([K, *src.PRODUCTS])} from hh", "hh"))
def household_flags(spark, sf_dir):
    return hh.household_flags(members(spark, sf_dir), src.PRODUCTS)


@query("household_outer", sql(f"select {columns([K, *MODE_COLUMNS, *_COSTS, *src.PRODUCTS])} from hh", "hh"))
def household_outer(spark, sf_dir):
    m = members(spark, sf_dir)
    parts = [hh.household_mode(m), hh.household_cost(m), hh.household_flags(m, src.PRODUCTS)]
    return plain(hh.household_outer(*parts))


@query("household_rollup", sql(f"select {columns(HOUSEHOLD)} from hh", "hh"))
def household_rollup(spark, sf_dir):
    return plain(hh.household_rollup(members(spark, sf_dir), src.PRODUCTS).select(*HOUSEHOLD))


@query("sink_parquet", sql(f"select {columns(HOUSEHOLD)} from hh", "hh"))
def sink_parquet(spark, sf_dir):
    path = scratch_path(spark, "household-table")
    io.write_parquet(hh.household_rollup(members(spark, sf_dir), src.PRODUCTS), path)
    return plain(io.scan_parquet(spark, path, HOUSEHOLD))


@query("engineer_features", sql(f"select {columns(FEATURES)} from feat", "feat"))
def engineer_features(spark, sf_dir):
    return plain(features(spark, sf_dir).select(*FEATURES))


@query("income_q75", sql("select q75 from q75", "q75"))
def income_q75(spark, sf_dir):
    return spark.createDataFrame([(ft.income_q75(households(spark, sf_dir)),)], "q75 double")


@query("is_high_income", sql("select household_key, income_mean, is_high_income from feat", "feat"))
def is_high_income(spark, sf_dir):
    table = households(spark, sf_dir).select(K, "income_mean")
    return ft.is_high_income(table)


_LEAK_FREE = [c for c in FEATURES if c not in clean.leakage_columns(FEATURES)]


@query("drop_leakage", sql(f"select {columns(_LEAK_FREE)} from feat", "feat"))
def drop_leakage(spark, sf_dir):
    return plain(clean.drop_leakage(features(spark, sf_dir)))


@query("drop_all_null", sql(f"select {columns([K, *_MEANS])} from hh", "hh"))
def drop_all_null(spark, sf_dir):
    table = households(spark, sf_dir).select(K, *_MEANS)
    return clean.drop_all_null(table.withColumn("never_filled", F.lit(None).cast("double")))


@query(
    "regression_target",
    sql("select household_key, coalesce(total_cost_sum, 0)::double as target from hh", "hh"),
)
def regression_target(spark, sf_dir):
    return plain(ft.regression_target(households(spark, sf_dir)).select(K, "target"))


@query("preprocess_households", sql(f"select {columns(FEATURES)} from feat", "feat"))
def preprocess_households(spark, sf_dir):
    from hearthscore.plans.preprocess import preprocess
    from hearthscore.queries.catalog import calls

    return plain(preprocess(calls(spark, sf_dir, grouped=True), src.COST_YEARS).select(*FEATURES))
