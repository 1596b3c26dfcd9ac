"""Derived household features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthscore.functions.encode import zero_if_null
from hearthscore.operators.household import cost_columns
from hearthscore.operators.quantiles import exact_percentiles


def _total(columns: Sequence[str]) -> Column:
    total = F.lit(0)
    for c in columns:
        total = total + zero_if_null(c)
    return total


def _flag(test: Column) -> Column:
    return F.coalesce(test, F.lit(False)).cast("int")


def income_q75(df: DataFrame) -> float | None:
    """Exact 75th percentile of household income, linearly interpolated."""
    return exact_percentiles(df, ["income_mean"], [0.75])["income_mean"][0.75]


def is_high_income(df: DataFrame, q75: float | None = None) -> DataFrame:
    q75 = income_q75(df) if q75 is None else q75
    return df.withColumn("is_high_income", _flag(F.col("income_mean") >= F.lit(q75)))


def engineer_features(
    df: DataFrame, products: Sequence[str], q75: float | None = None
) -> DataFrame:
    """Add use, cost, depth, loyalty, income and trend features."""
    calls = [c for c in df.columns if c.startswith("ers_ent_count_year") and c.endswith("_sum")]
    held = [p for p in products if p in df.columns]
    out = df.withColumns(
        {
            "total_ers_calls": _total(calls).cast("double"),
            "product_count": _total(held).cast("int"),
        }
    )
    new = {
        "is_multi_product": _flag(F.col("product_count") >= 2),
        "has_used_ers": _flag(F.col("total_ers_calls") > 0),
    }
    if "total_cost_sum" in df.columns:
        new["avg_cost_per_call"] = F.col("total_cost_sum").cast("double") / (
            F.col("total_ers_calls") + F.lit(0.001)
        )
    if "member_tenure_years_mean" in df.columns:
        new["is_long_term_member"] = _flag(F.col("member_tenure_years_mean") >= 10)
    years = sorted(c for c in df.columns if c.endswith("_sum") and cost_columns([c[:-4]]))
    if len(years) >= 2:
        new["cost_trend"] = F.col(years[-1]) - F.col(years[0])
    out = out.withColumns(new)
    return is_high_income(out, q75) if "income_mean" in df.columns else out


def regression_target(df: DataFrame, configured: str = "total_cost_sum") -> DataFrame:
    """Add ``target``: the configured cost column, else the first total, null as 0."""
    name = configured
    if name not in df.columns:
        candidates = [c for c in df.columns if "total_cost" in c]
        if not candidates:
            raise ValueError("no cost column to predict")
        name = candidates[0]
    return df.withColumn("target", zero_if_null(name))
