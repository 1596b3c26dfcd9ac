"""Business rules that turn numbers into labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def propensity_tier(score: Column) -> Column:
    return F.when(score > 0.5, "high").when(score > 0.25, "medium").otherwise("low")


def priority_tier(score: Column) -> Column:
    return (
        F.when(score > 0.5, "highest").when(score > 0.25, "second wave").otherwise("nurture")
    )


def lift_band(lift: Column) -> Column:
    return F.when(lift >= 4, "strong").when(lift >= 2.5, "good").otherwise("modest")


def r2_verdict(r2: Column) -> Column:
    return F.when(r2 > 0.60, "suspicious").when(r2 > 0.25, "good").otherwise("low")


def auc_met(auc: Column) -> Column:
    return auc >= 0.70


def lift_met(lift: Column) -> Column:
    return lift >= 2.0


def r2_met(r2: Column) -> Column:
    return r2 >= 0.25


def non_negative(prediction: Column) -> Column:
    return F.greatest(prediction, F.lit(0.0))
