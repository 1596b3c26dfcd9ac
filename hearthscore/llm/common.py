"""What several text operators share: names, staged tables, joins with hot keys."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import zip_longest

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthscore.session import stage_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())

# A key is heavy when it holds more than this share of the rows, so there are
# at most 1024 heavy keys however large the table is.
HEAVY_SHARE = 1024


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def hex64(value: Column) -> Column:
    """A long as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on ``keys``."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def lookup(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join ``left`` to ``right``, which has one row per key, whatever the skew.

    Rows of heavy keys (more than one in 1024 rows of ``left``) meet their at
    most 1024 partners by broadcast and never shuffle; the others are joined by
    a shuffle in which no key is large.  Keys must not be null; ``how`` is
    ``left`` or ``inner``.  ``left`` is read several times: pass a staged table.
    """
    per_key = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rows = left.count()
    heavy = per_key.where(F.col("_n") * HEAVY_SHARE > rows).select(*keys)
    heavy = stage_table(heavy, "heavy")
    light = left.join(F.broadcast(heavy), keys, "left_anti").join(right, keys, how)
    partners = right.join(F.broadcast(heavy), keys, "left_semi")
    hot = left.join(F.broadcast(heavy), keys, "left_semi").join(F.broadcast(partners), keys, how)
    return light.unionByName(hot)


def pylists(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of an Arrow batch as tuples."""
    return zip_longest(*(c.to_pylist() for c in batch.columns))


def batch_of(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    """An Arrow batch from row tuples."""
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )
