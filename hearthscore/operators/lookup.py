"""Finding single households and their scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthscore.operators.propensity import propensity_columns, score_products
from hearthscore.operators.recommend import household_scores
from hearthscore.operators.split import key_hash

KEY = "household_key"


def household_keys(df: DataFrame, n: int = 500) -> DataFrame:
    """The first ``n`` household keys in order, for a pick list."""
    return df.select(KEY).distinct().orderBy(KEY).limit(n)


def random_household(df: DataFrame, seed: int) -> DataFrame:
    """One household drawn by hash: the same draw for the same seed."""
    return df.select(KEY).orderBy(key_hash(KEY, seed), KEY).limit(1)


def find_households(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of the households named in ``keys``."""
    return df.join(keys.select(KEY), KEY, "left_semi")


def score_households(df: DataFrame, keys: DataFrame, base: str) -> DataFrame:
    """Ranked product scores of the named households, from the registered models."""
    wide = score_products(find_households(df, keys), base)
    return household_scores(wide, KEY, propensity_columns(wide))
