"""Registry of queries and their checking SQL, and frames several queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthscore.operators import household as hh
from hearthscore.operators import members as mb
from hearthscore.operators.features import engineer_features
from hearthscore.session import stage_table
from hearthscore.sources import tpch_calls as src

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Output types both engines render alike: no decimals, timestamps, structs."""
    out = []
    for f in df.schema.fields:
        col = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            out.append(col.cast("double").alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_format(col, "yyyy-MM-dd").alias(f.name))
        elif not isinstance(f.dataType, T.StructType):
            out.append(col)
    return df.select(*out)


def calls(spark: SparkSession, sf_dir: str, grouped: bool = False) -> DataFrame:
    return src.raw_calls(spark, sf_dir, grouped)


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mb.encoded_members(calls(spark, sf_dir, grouped=True), src.COST_YEARS)


def households(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The household table or the named columns of it; written once, since several passes follow."""
    rolled = hh.household_rollup(members(spark, sf_dir), src.PRODUCTS)
    return stage_table(rolled.select(*columns) if columns else rolled, "households")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engineer_features(households(spark, sf_dir), src.PRODUCTS)
