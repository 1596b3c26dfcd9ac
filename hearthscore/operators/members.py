"""Call rows to one row per member, and call costs by year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthscore.config import FLAG_SUFFIX, KEEP_STATUS
from hearthscore.functions.encode import call_year
from hearthscore.operators.clean import (
    GROUP_COLUMN,
    ORDER_COLUMN,
    encode_flags,
    encode_ordinals,
    filter_status,
    select_whitelist,
)


def _member(df: DataFrame) -> list[str]:
    """Grouping columns of a member: with its group, rows that lie by group need no exchange."""
    return [*[c for c in (GROUP_COLUMN,) if c in df.columns], "member_key"]


def dedup_first(df: DataFrame, key: str = "member_key", order: str = ORDER_COLUMN) -> DataFrame:
    """First row per key in an explicit order.

    The ``row_number() = 1`` form lets Spark keep one row per key in every map
    task before the shuffle, so a key with very many rows stays cheap.
    """
    first = Window.partitionBy(key).orderBy(order)
    return df.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def cost_years(df: DataFrame) -> list[int]:
    """Calendar years with dated calls (a handful of rows)."""
    years = df.select(F.year("sc_date").alias("y")).filter("y is not null").distinct()
    return sorted(r.y for r in years.collect())


def cost_by_year(df: DataFrame) -> DataFrame:
    """Cost per member and call year; year 0 collects the undated calls."""
    return df.groupBy("member_key", call_year("sc_date").alias("call_year")).agg(
        F.coalesce(F.sum("total_cost"), F.lit(0)).alias("cost")
    )


def _year_sums(years: Sequence[int]) -> list:
    year = F.year("sc_date")
    return [
        F.coalesce(F.sum(F.when(year == y, F.col("total_cost"))), F.lit(0)).alias(f"cost_{y}")
        for y in years
    ]


def _dated_total():
    """Cost of all dated calls, whichever years have columns."""
    dated = F.when(F.col("sc_date").isNotNull(), F.col("total_cost"))
    return F.coalesce(F.sum(dated), F.lit(0)).alias("total_cost")


def cost_pivot(df: DataFrame, years: Sequence[int]) -> DataFrame:
    """One row per member with a cost column per year and the total of all years.

    Conditional sums need one shuffle where a pivot needs two.  Undated calls
    are in no year column and not in the total; calls of a year that is not
    listed are in the total only.
    """
    return df.groupBy(*_member(df)).agg(*_year_sums(years), _dated_total()).drop(GROUP_COLUMN)


def member_costs(members: DataFrame, costs: DataFrame) -> DataFrame:
    """Attach yearly costs to deduplicated members; no call means zero cost."""
    cost_cols = [c for c in costs.columns if c != "member_key"]
    base = members.drop("total_cost", "sc_date")
    return base.join(costs, "member_key", "left").fillna(0, subset=cost_cols)


def encoded_members(df: DataFrame, years: Sequence[int]) -> DataFrame:
    """Raw calls to encoded members with yearly costs, in one shuffle, or none if they lie by group.

    Costs are summed over all of a member's calls; attributes come from the
    first call with an accepted status; members without one are dropped.  Both
    are aggregates over the same key, so the raw rows are read once, reduced in
    the map tasks and shuffled once, where a separate deduplication, pivot and
    join would read and shuffle them twice.
    """
    kept = select_whitelist(df)
    dropped = ("member_key", "member_status", "total_cost", "sc_date", ORDER_COLUMN, GROUP_COLUMN)
    payload = [c for c in kept.columns if c not in dropped]
    row = F.struct(F.col(ORDER_COLUMN), *payload)
    if "member_status" in kept.columns:
        row = F.when(F.col("member_status").isin(*KEEP_STATUS), row)
    grouped = kept.groupBy(*_member(kept)).agg(
        F.min(row).alias("_first"), *_year_sums(years), _dated_total()
    )
    flat = grouped.filter("_first is not null").select(
        "member_key",
        *[F.col(f"_first.{c}").alias(c) for c in payload],
        *[f"cost_{y}" for y in years],
        "total_cost",
    )
    return encode_flags(encode_ordinals(flat))


def members_by_household(df: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Flags of the members' first accepted calls, and ``sums`` over all accepted ones, in one pass.

    One row per member and household of its calls.  Only the row of the household
    that ``encoded_members`` gives the member to has the member's key and flags; the
    sums stay with the household of each call.  Calls that tie in the order are
    compared by flags and household, the first columns that decide there too.
    """
    kept = filter_status(df)
    flags = [c for c in kept.columns if c.endswith(FLAG_SUFFIX)]
    row = F.struct(ORDER_COLUMN, *flags, "household_key")
    grouped = kept.groupBy(*_member(kept), "household_key").agg(
        F.min(row).alias("_own"), *[c.alias(name) for name, c in sums.items()]
    )
    first = F.min("_own").over(Window.partitionBy(*_member(kept)))
    flat = grouped.withColumn("_first", F.col("_own").eqNullSafe(first)).select(
        F.when(F.col("_first"), F.col("member_key")).alias("member_key"),
        "household_key",
        *[F.when(F.col("_first"), F.col(f"_own.{c}")).alias(c) for c in flags],
        *sums,
    )
    return encode_flags(flat)
