"""Members to households."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthscore.config import CALL_COLUMNS, MEAN_COLUMNS, MISSING_LABEL, MODE_COLUMNS
from hearthscore.functions.encode import mean_of

KEY = "household_key"


def _mode(df: DataFrame) -> list:
    """Most frequent label, lowest one on a tie; a missing value is a label too.

    The aggregation buffer holds one counter per distinct label of a household,
    never the rows, so it is bounded by the column's label set.
    """
    return [
        F.mode(F.coalesce(F.col(c), F.lit(MISSING_LABEL)), deterministic=True).alias(c)
        for c in MODE_COLUMNS
        if c in df.columns
    ]


def _means(df: DataFrame) -> list:
    return [mean_of(c).alias(f"{c}_mean") for c in MEAN_COLUMNS if c in df.columns]


def _calls(df: DataFrame) -> list:
    out = []
    for c in CALL_COLUMNS:
        if c in df.columns:
            out.append(F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_sum"))
            out.append(mean_of(c).alias(f"{c}_mean"))
    return out


def cost_columns(columns) -> list[str]:
    return [c for c in columns if c.startswith("cost_") and c[5:].isdigit()]


def _costs(df: DataFrame) -> list:
    names = cost_columns(df.columns) + (["total_cost"] if "total_cost" in df.columns else [])
    return [F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_sum") for c in names]


def _flags(products: Sequence[str]) -> list:
    return [F.max(p).alias(p) for p in products]


def _by_household(df: DataFrame, aggregates: list) -> DataFrame:
    return df.filter(F.col(KEY).isNotNull()).groupBy(KEY).agg(*aggregates)


def household_mode(df: DataFrame) -> DataFrame:
    return _by_household(df, _mode(df))


def household_mean(df: DataFrame) -> DataFrame:
    return _by_household(df, _means(df))


def household_calls(df: DataFrame) -> DataFrame:
    return _by_household(df, _calls(df))


def household_cost(df: DataFrame) -> DataFrame:
    return _by_household(df, _costs(df))


def household_size(df: DataFrame) -> DataFrame:
    return _by_household(df, [F.count("member_key").alias("members")])


def household_flags(df: DataFrame, products: Sequence[str]) -> DataFrame:
    return _by_household(df, _flags(products))


def household_outer(*parts: DataFrame) -> DataFrame:
    """Full outer join of separately built household parts."""
    first, *rest = parts
    for part in rest:
        first = first.join(part, KEY, "full_outer")
    return first


def household_rollup(df: DataFrame, products: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """All household columns from a single aggregation, with the totals of ``sums`` under their names."""
    return _by_household(
        df,
        [
            *_mode(df),
            F.count("member_key").alias("members"),
            *_means(df),
            *_calls(df),
            *_costs(df),
            *_flags(products),
            *[F.sum(c).alias(c) for c in sums],
        ],
    )
