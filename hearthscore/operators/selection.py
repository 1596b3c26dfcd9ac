"""Choosing among scored models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthscore.functions.tiers import auc_met, lift_met


def best_model(scorecards: DataFrame, target: str = "product", metric: str = "roc_auc", smaller: bool = False) -> DataFrame:
    """Best row per target (largest or smallest metric, then model name).

    Scorecards hold one row per (target, model).
    """
    first = F.asc(metric) if smaller else F.desc(metric)
    place = F.row_number().over(Window.partitionBy(target).orderBy(first, "model"))
    return scorecards.withColumn("_place", place).filter("_place = 1").drop("_place")


def targets_met(scorecards: DataFrame) -> DataFrame:
    return scorecards.withColumns(
        {"auc_met": auc_met(F.col("roc_auc")), "lift_met": lift_met(F.col("lift_at_10"))}
    )


def sorted_summary(scorecards: DataFrame) -> DataFrame:
    return scorecards.orderBy("product", F.desc("roc_auc"), "model")
