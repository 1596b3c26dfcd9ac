"""Balanced shards by histogram sort.

Rows are ordered by a key of hex digits.  The driver keeps a histogram of exact
byte counts between candidate key boundaries; each round splits only the cells
that hold an unmet target one digit further, until every splitter is within
tolerance or on a single row.  Then the rows are exchanged once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthscore.llm.common import fresh, hex64
from hearthscore.session import stage_table

TOLERANCE = 0.01  # of a shard's fair share
RANGE_BYTES = 256 * 1024**2  # a shard is sorted in ranges of about this size
FIRST_DIGITS = 2
HASH_DIGITS = 16


def order_key(group: Column, row_id: Column) -> Column:
    """Sort key: hash of the group, hash of the id, a number unique to the row.

    Equal groups are neighbours; because the last part is unique, a boundary
    can be found inside any run of equal rows.
    """
    unique = F.xxhash64(F.monotonically_increasing_id())
    return F.concat(hex64(F.xxhash64(group)), hex64(F.xxhash64(row_id)), hex64(unique))


def find_splitters(rows: DataFrame, key: str, size: str, parts: int, loose: int = 1):
    """Key boundaries that cut ``rows`` into ``parts`` of near equal ``size``.

    Every ``loose``-th boundary (a shard's) meets ``TOLERANCE`` of the fair
    share of a shard, the others a quarter of a part, unless a single row lies
    on it.  Returns the
    boundaries (a row belongs after each one that is <= its key) and the rows
    before each.
    """

    def histogram(digits: int, source: DataFrame) -> list[tuple[str, int, int]]:
        cells = source.groupBy(F.substring(key, 1, digits).alias("cell")).agg(
            F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("n")
        )
        return sorted((r.cell, int(r.bytes), r.n) for r in cells.collect())

    total = rows.agg(F.sum(size)).first()[0]
    if not total:
        return [], []
    targets = [total * i / parts for i in range(1, parts)]
    limits = [
        TOLERANCE * total * loose / parts if i % loose == 0 else 0.25 * total / parts
        for i in range(1, parts)
    ]
    digits, cells = FIRST_DIGITS, histogram(FIRST_DIGITS, rows)
    while True:
        ends = np.cumsum([c[1] for c in cells])
        at = np.searchsorted(ends, targets)  # the cell that holds each target
        open_cells = set()
        for t, limit, c in zip(targets, limits, at):
            start, end = ends[c] - cells[c][1], ends[c]
            if min(t - start, end - t) > limit and cells[c][2] > 1 and len(cells[c][0]) == digits:
                open_cells.add(cells[c][0])
        if not open_cells or digits == 3 * HASH_DIGITS:
            break
        finer = rows.where(F.substring(key, 1, digits).isin(sorted(open_cells)))
        digits += 1
        cells = sorted([c for c in cells if c[0] not in open_cells] + histogram(digits, finer))
    counts = np.cumsum([c[2] for c in cells])
    bounds, before = [], []
    for t, c in zip(targets, at):
        start, end = ends[c] - cells[c][1], ends[c]
        after = c + 1 if end - t <= t - start else c  # first cell behind the boundary
        bounds.append(cells[after][0] if after < len(cells) else "g")
        before.append(int(counts[after - 1]) if after else 0)
    return bounds, before


def shard_rows(
    df: DataFrame, shards: int, size: str, group: Column, row_id: Column
) -> DataFrame:
    """Add ``shard`` (0 .. shards-1) and ``slot`` (gapless from 0 in each shard).

    ``size`` names a column of positive sizes; shards get near equal sums of
    it.  Rows of one ``group`` are neighbours and stay in one shard unless a
    shard boundary within tolerance exists only inside the group.  Null groups
    and ids hash like any other value; repeated rows are kept apart by a row
    number; columns named ``shard`` or ``slot`` are replaced, others pass
    unchanged; an empty table gives an empty result.  All columns are staged once and exchanged once.
    """
    df = df.drop("shard", "slot")
    key, found, part, first = fresh(df, "_key", "_at", "_range", "_first")
    df = df.withColumn(key, order_key(group, row_id))
    rows = stage_table(df, "shard_rows")
    total = rows.agg(F.sum(size)).first()[0] or 0
    ranges = max(1, math.ceil(total / shards / RANGE_BYTES))
    bounds, before = find_splitters(rows, key, size, shards * ranges, ranges)
    cuts = np.array(bounds, dtype=f"U{3 * HASH_DIGITS}")
    starts = np.array([0, *before], dtype=np.int64)

    @F.pandas_udf("range int, shard int, first long")
    def place(keys: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(cuts, keys.to_numpy(dtype=cuts.dtype), side="right")
        shard = at // ranges
        ahead = starts[at] - starts[shard * ranges] if len(cuts) else np.zeros(len(at), np.int64)
        return pd.DataFrame({"range": at, "shard": shard, "first": ahead})

    placed = rows.withColumn(found, place(key)).select(
        "*",
        F.col(found)["range"].alias(part),
        F.col(found)["shard"].alias("shard"),
        F.col(found)["first"].alias(first),
    )
    moved = placed.repartitionById(shards * ranges, F.col(part))
    order = Window.partitionBy(part).orderBy(key)
    slot = F.col(first) + F.row_number().over(order) - 1
    return moved.withColumn("slot", slot).drop(key, found, part, first)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder of Parquet files per shard."""
    sharded.write.option("compression", "zstd").partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rows of all shards, with the columns of the table that was written."""
    return spark.read.schema(like.schema).parquet(path)
