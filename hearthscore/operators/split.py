"""Deterministic train/validation/test splits and class weights."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthscore.operators.quantiles import order_statistics


def key_hash(key: str, seed: int) -> Column:
    """60 bits of MD5 over key and seed: the same order in any engine."""
    digest = F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _size(n: int, share: float) -> int:
    return math.floor(n * share + 0.5)


def stratified_split(
    df: DataFrame,
    key: str,
    label: str | None,
    test_share: float,
    validation_share: float = 0.0,
    seed: int = 42,
) -> DataFrame:
    """Add ``split`` with exact shares of every class.

    Rows take their place by hash; the hash values that bound the shares are
    order statistics, so the split is a comparison with two constants per class
    and moves no data.
    """
    hashed = df.withColumn("_hash", key_hash(key, seed)).withColumn(
        "_class", F.col(label).cast("string") if label else F.lit("all")
    )
    sizes: dict[str, tuple[int, int]] = {}

    def ranks(name: str, n: int) -> list[int]:
        test = _size(n, test_share)
        held = min(test + _size(n, validation_share), n)
        sizes[name] = (test, held)
        return sorted({k - 1 for k in (test, held) if k > 0})

    at = order_statistics(hashed.select("_class", "_hash"), "_class", "_hash", ranks)
    out = F.lit("train")
    for name, (test, held) in sizes.items():
        mine = F.col("_class") == name
        test_cut = at[name, test - 1] if test else -1
        held_cut = at[name, held - 1] if held else -1
        split = F.when(F.col("_hash") <= test_cut, "test")
        split = split.when(F.col("_hash") <= held_cut, "validation").otherwise("train")
        out = F.when(mine, split).otherwise(out)
    return hashed.withColumn("split", out).drop("_hash", "_class")


def hash_split(
    df: DataFrame, key: str, test_share: float, seed: int = 42, validation_share: float = 0.0
) -> DataFrame:
    return stratified_split(df, key, None, test_share, validation_share, seed)


def split_profile(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(label)).alias("positive_rate")
    )


def class_weights(df: DataFrame, label: str) -> dict[int, float]:
    """n / (classes * n_class) per class."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())
    return {c: n / (len(counts) * k) for c, k in counts.items()}


def with_class_weight(df: DataFrame, label: str, weights: dict[int, float]) -> DataFrame:
    out = F.lit(1.0)
    for value, weight in sorted(weights.items()):
        out = F.when(F.col(label) == value, F.lit(weight)).otherwise(out)
    return df.withColumn("weight", out)
