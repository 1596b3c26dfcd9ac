"""Offers per household, tiers and campaign arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthscore.config import NURTURE_LABEL, Settings
from hearthscore.functions.tiers import priority_tier, propensity_tier
from hearthscore.operators.explore import with_share
from hearthscore.operators.segments import argmax_product


def attach_recommendation(households: DataFrame, actions: DataFrame) -> DataFrame:
    """Give each household its segment's name and offer (one action row per segment)."""
    lookup = actions.select("cluster", "cluster_name", "recommended_product")
    return households.join(F.broadcast(lookup), "cluster", "left")


def recommendation_distribution(recommended: DataFrame) -> DataFrame:
    counts = recommended.groupBy("recommended_product").agg(F.count(F.lit(1)).alias("n"))
    return with_share(counts).select(
        "recommended_product", "n", F.round(F.col("share") * 100, 1).alias("share_pct")
    )


def nurture_split(recommended: DataFrame) -> DataFrame:
    nurture = (F.col("recommended_product") == NURTURE_LABEL).alias("is_nurture")
    return with_share(recommended.groupBy(nurture).agg(F.count(F.lit(1)).alias("n")))


def segments_by_tier(actions: DataFrame, tier: str | None = None) -> DataFrame:
    out = actions.withColumn("tier", priority_tier(F.col("avg_propensity")))
    return out if tier is None else out.filter(F.col("tier") == tier)


def long_scores(wide: DataFrame, key: str, score_columns: dict[str, str]) -> DataFrame:
    """(key, product, score) from one column per product."""
    if not score_columns:
        none = wide.limit(0).withColumns({"product": F.lit(""), "score": F.lit(0.0)})
        return none.select(key, "product", "score")
    options = [
        F.struct(F.lit(p).alias("product"), F.col(c).cast("double").alias("score"))
        for p, c in score_columns.items()
    ]
    return wide.select(key, F.inline(F.array(*options)))


def household_scores(wide: DataFrame, key: str, score_columns: dict[str, str]) -> DataFrame:
    """A household's products, best first, with the tier of each score.

    The ranking is a sort of the handful of scores inside the row.
    """
    if not score_columns:
        none = long_scores(wide, key, {}).withColumns({"place": F.lit(0), "tier": F.lit("")})
        return none.select(key, "place", "product", "score", "tier")
    options = [
        F.struct(
            (-F.col(c).cast("double")).alias("o"),
            F.lit(p).alias("product"),
            F.col(c).cast("double").alias("score"),
        )
        for p, c in score_columns.items()
    ]
    ranked = wide.select(key, F.posexplode(F.array_sort(F.array(*options))).alias("i", "s"))
    return ranked.select(
        key,
        (F.col("i") + 1).alias("place"),
        F.col("s.product").alias("product"),
        F.col("s.score").alias("score"),
        propensity_tier(F.col("s.score")).alias("tier"),
    )


def household_top_offer(
    wide: DataFrame, key: str, score_columns: dict[str, str], min_propensity: float = 0.15
) -> DataFrame:
    """Best product per household, or nurture when its score is too low."""
    by_name = dict(sorted(score_columns.items()))
    best = argmax_product(wide, by_name)
    offer = F.when(F.col("best_score") > min_propensity, F.col("best_product"))
    return best.select(
        key,
        F.col("best_product").alias("top_product"),
        F.col("best_score").alias("top_score"),
        F.coalesce(offer, F.lit(NURTURE_LABEL)).alias("offer"),
    )


def campaign_value(best: DataFrame, n_households: int, settings: Settings) -> DataFrame:
    """Buyers found by contacting the top share, at random and by model.

    ``best`` holds one row per product: base_rate and lift_at_10.
    """
    contacts = int(n_households * settings.contact_share)
    random_finds = F.floor(F.lit(contacts) * F.col("base_rate"))
    model_finds = F.floor(F.lit(contacts) * F.col("base_rate") * F.col("lift_at_10"))
    return best.select(
        "product",
        "base_rate",
        "lift_at_10",
        F.lit(contacts).cast("bigint").alias("contacts"),
        random_finds.alias("random_finds"),
        model_finds.alias("model_finds"),
        (model_finds - random_finds).alias("uplift"),
        F.lit(contacts * settings.contact_cost).cast("bigint").alias("budget"),
    )


def contact_reduction(
    best: DataFrame, n_households: int, n_products: int, settings: Settings
) -> DataFrame:
    """Targeted contacts against contacting everyone about everything."""
    contacts = int(n_households * settings.contact_share)
    equivalent = F.floor(F.lit(contacts) * F.col("lift_at_10"))
    return best.select(
        "product",
        F.lit(n_households * n_products).cast("bigint").alias("untargeted_contacts"),
        F.lit(contacts).cast("bigint").alias("targeted_contacts"),
        equivalent.alias("random_equivalent"),
        (equivalent - contacts).alias("contacts_saved"),
    )
