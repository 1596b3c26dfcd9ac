"""Token-budget batches in length buckets of least padding."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthscore.session import stage_table

CELL_ROWS = 65536  # rows that one task numbers


@dataclass(frozen=True)
class PackSettings:
    max_len: int = 2048  # longest piece; longer documents are cut into pieces
    buckets: int = 16
    budget: int = 32768  # padded tokens of a batch


@F.arrow_udf(T.LongType())
def _words(texts: pa.Array) -> pa.Array:
    return pa.array([len(t.as_py().split()) if t.is_valid else 0 for t in texts], pa.int64())


def word_count(text: str) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text column, null as none."""
    return _words(F.col(text).cast("binary"))


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Bucket upper bounds (values of ``lengths``, ascending) of least total padding.

    ``lengths`` ascend without repeats.  Exact dynamic programme over prefixes
    of the histogram; fewer buckets result only if there are fewer lengths.
    """
    n = len(lengths)
    if n == 0:
        return []
    rows = np.concatenate(([0], np.cumsum(counts, dtype=np.float64)))
    tokens = np.concatenate(([0], np.cumsum(counts * lengths, dtype=np.float64)))
    buckets = min(buckets, n)
    # best[j]: least padding of the first j lengths; a bucket i..j pads to lengths[j-1]
    best = np.concatenate(([0.0], np.full(n, np.inf)))
    choice = np.zeros((buckets, n + 1), dtype=np.int64)
    for b in range(buckets):
        now = np.full(n + 1, np.inf)
        for j in range(b + 1, n + 1):
            cost = best[b:j] + lengths[j - 1] * (rows[j] - rows[b:j]) - (tokens[j] - tokens[b:j])
            i = int(np.argmin(cost))
            now[j], choice[b, j] = cost[i], b + i
        best = now
    bounds, j = [], n
    for b in range(buckets - 1, -1, -1):
        bounds.append(int(lengths[j - 1]))
        j = int(choice[b, j])
    return bounds[::-1]


def _literal_map(values: dict[int, int]) -> Column:
    return F.create_map(*[F.lit(x).cast("long") for kv in values.items() for x in kv])


def pack(df: DataFrame, id_col: str, length_col: str, settings: PackSettings = PackSettings()) -> DataFrame:
    """Cut rows into pieces, pieces into buckets, buckets into batches.

    Returns id, piece, first_token, n_tokens, bucket_len, batch_id and slot,
    one row per piece.  Nothing is dropped: a row longer than ``max_len`` gives
    several pieces; one of length zero or null keeps a row whose bucket_len,
    batch_id and slot are null.  All batches of a bucket but its last hold
    ``budget // bucket_len`` pieces.  Null and repeated ids pack like others;
    other columns are ignored; an empty table gives an empty result.

    Only the histogram (at most ``max_len`` rows) reaches the driver.  Batch
    numbers come from counts per cell of hashed pieces, so no task sees a
    whole bucket.
    """
    s = settings
    if s.budget < s.max_len:
        raise ValueError("the budget must hold one piece of the greatest length")
    length = F.greatest(F.coalesce(F.col(length_col).cast("long"), F.lit(0)), F.lit(0))
    rows = df.select(F.col(id_col).alias("id"), length.alias("n"))
    last = F.floor((F.greatest("n", F.lit(1)) - 1) / s.max_len).cast("long")
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    pieces = pieces.withColumn("first_token", F.col("piece") * s.max_len)
    size = F.least(F.col("n") - F.col("first_token"), F.lit(s.max_len).cast("long"))
    pieces = pieces.withColumn("n_tokens", size)
    pieces = pieces.withColumn("unit", F.monotonically_increasing_id()).drop("n")
    pieces = stage_table(pieces, "pieces")
    seen = pieces.where("n_tokens > 0").groupBy("n_tokens").agg(F.count(F.lit(1)).alias("c"))
    histogram = {r.n_tokens: r.c for r in seen.collect()}
    lengths = np.array(sorted(histogram), dtype=np.int64)
    counts = np.array([histogram[x] for x in lengths.tolist()], dtype=np.int64)
    bounds = best_boundaries(lengths, counts, s.buckets)
    columns = [F.col("id").alias(id_col), "piece", "first_token", "n_tokens"]
    empty = pieces.where("n_tokens = 0").select(
        *columns, *[F.lit(None).cast("long").alias(c) for c in ("bucket_len", "batch_id", "slot")]
    )
    if not bounds:
        return empty
    held = {b: int(counts[(lengths <= b) & (lengths > a)].sum()) for a, b in zip([0, *bounds], bounds)}
    room = {b: s.budget // b for b in bounds}
    batches = [-(-held[b] // room[b]) for b in bounds]
    first_batch = dict(zip(bounds, np.concatenate(([0], np.cumsum(batches)[:-1])).tolist()))
    cells = {b: -(-held[b] // CELL_ROWS) for b in bounds}
    steps = F.array(*[F.lit(b).cast("long") for b in bounds])
    bucket = F.element_at(F.filter(steps, lambda b: b >= F.col("n_tokens")), 1)
    cut = pieces.where("n_tokens > 0").withColumn("bucket_len", bucket)
    cell = F.pmod(F.xxhash64("unit"), F.element_at(_literal_map(cells), F.col("bucket_len")))
    cut = cut.withColumn("cell", cell)
    in_cell = Window.partitionBy("bucket_len", "cell").orderBy("unit")
    numbered = cut.withColumn("at", F.row_number().over(in_cell) - 1)
    sizes = cut.groupBy("bucket_len", "cell").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("bucket_len").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket_len", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("ahead"))
    placed = numbered.join(offsets, ["bucket_len", "cell"])
    place = F.col("ahead") + F.col("at")
    capacity = F.element_at(_literal_map(room), F.col("bucket_len"))
    start = F.element_at(_literal_map(first_batch), F.col("bucket_len"))
    full = placed.select(
        *columns,
        "bucket_len",
        (start + F.floor(place / capacity)).cast("long").alias("batch_id"),
        (place % capacity).cast("long").alias("slot"),
    )
    return full.unionByName(empty)
