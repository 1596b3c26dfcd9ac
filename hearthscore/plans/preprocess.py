"""Raw calls to the household feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from hearthscore.config import products_in
from hearthscore.operators.features import engineer_features
from hearthscore.operators.household import household_rollup
from hearthscore.operators.matrix import sparse_matrix
from hearthscore.operators.members import cost_years, encoded_members
from hearthscore.session import stage_table


def preprocess(raw: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """One shuffle per member, one per household, then the derived features.

    The household table is written once: the income percentile needs a pass over
    it, and so does every later consumer.
    """
    products = products_in(raw.columns)
    years = cost_years(raw) if years is None else years
    rolled = household_rollup(encoded_members(raw, years), products)
    return engineer_features(stage_table(rolled, "households"), products)


def preprocess_pipeline(
    raw: DataFrame, years: Sequence[int] | None = None, drop: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw calls to the matrix, the names of its slots, and the household table.

    The matrix holds every household feature but the products and ``drop``, with
    labels and medians learned from the table, and no nulls.
    """
    table = stage_table(preprocess(raw, years), "household_features")
    matrix, names = sparse_matrix(table, [*products_in(raw.columns), *drop])
    return matrix, names, table
