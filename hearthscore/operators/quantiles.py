"""Exact order statistics without sorting the data.

Each pass narrows the interval that must hold the wanted rank, using a sketch
built with partial aggregation, and counts exactly how many values lie below.
What remains is a small interval whose distinct values are counted and ranked.
Rows are never shuffled, so neither size nor a heavily repeated value matters.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GRID = 256
SKETCH_ACCURACY = 10_000
MAX_INTERVAL_ROWS = 500_000  # narrowing goes on until intervals hold no more


def _sketch(value):
    grid = [i / GRID for i in range(GRID + 1)]
    return F.percentile_approx(value, grid, SKETCH_ACCURACY)


def _slack(x) -> int:
    """What a long may lose in a sketch, which computes in doubles of 53 bits."""
    return abs(x) >> 52 if isinstance(x, int) else 0


def _narrow(points: list, rank: int, count: int, least, most):
    """Grid neighbours that enclose ``rank`` with a margin of a grid step and two rows.

    ``least`` and ``most`` bound the values exactly; beyond the grid they take over.
    """
    at = rank / max(count - 1, 1) * GRID
    margin = 1 + math.ceil(2 * GRID / max(count - 1, 1))
    low, high = math.floor(at) - margin, math.ceil(at) + margin
    return (
        max(least, points[low] - _slack(points[low])) if low > 0 else least,
        min(most, points[high] + _slack(points[high])) if high < GRID else most,
    )


def order_statistics(
    df: DataFrame,
    group: str,
    value: str,
    ranks: Callable[[str, int], Sequence[int]],
) -> dict[tuple[str, int], float]:
    """Values at the wanted 0-based ranks of each group.

    ``ranks(group, count)`` names them.  Groups are few by construction (column
    names, classes, models): the result has one entry per group and rank.
    NULL values are left out.
    """
    long = df.select(F.col(group).alias("_g"), F.col(value).alias("_v")).filter("_v is not null")
    kind = long.schema["_v"].dataType.simpleString()
    head = long.groupBy("_g").agg(
        F.count("_v").alias("n"),
        F.min("_v").alias("least"),
        F.max("_v").alias("most"),
        _sketch("_v").alias("points"),
    ).collect()
    found = {
        (row["_g"], r): _narrow(row["points"], r, row["n"], row["least"], row["most"])
        for row in head
        for r in ranks(row["_g"], row["n"])
    }
    if not found:
        return {}

    while True:
        intervals = sorted({(g, lo, hi) for (g, _), (lo, hi) in found.items()}, key=repr)
        near, label = _inside(long, intervals, kind)
        stats = {
            row["_i"]: row
            for row in near.groupBy("_i")
            .agg(
                F.count_if("_below").alias("below"),
                F.count_if(~F.col("_below")).alias("inside"),
                _sketch(F.when(~F.col("_below"), F.col("_v"))).alias("points"),
            )
            .collect()
        }
        narrower = {}
        for (g, r), (lo, hi) in found.items():
            s = stats[label[g, lo, hi]]
            if not s["below"] <= r < s["below"] + s["inside"]:
                raise RuntimeError(f"rank {r} of {g} lies outside its interval")
            if s["inside"] > MAX_INTERVAL_ROWS and lo < hi:
                closer = _narrow(s["points"], r - s["below"], s["inside"], lo, hi)
                if closer != (lo, hi):
                    narrower[g, r] = closer
        if not narrower:
            return _pick(near, label, found)
        found |= narrower


def _inside(long: DataFrame, intervals: list, kind: str):
    """Rows below or inside each interval; the interval table is tiny."""
    spark = long.sparkSession
    label = {interval: i for i, interval in enumerate(intervals)}
    group_kind = long.schema["_g"].dataType.simpleString()
    table = spark.createDataFrame(
        [(i, g, lo, hi) for (g, lo, hi), i in label.items()],
        f"_i int, _h {group_kind}, _lo {kind}, _hi {kind}",
    )
    near = long.join(
        F.broadcast(table), (F.col("_g") == F.col("_h")) & (F.col("_v") <= F.col("_hi"))
    ).select("_i", "_v", (F.col("_v") < F.col("_lo")).alias("_below"))
    return near, label


def _pick(near: DataFrame, label: dict, found: dict) -> dict:
    spark = near.sparkSession
    counted = near.groupBy("_i", F.when(~F.col("_below"), F.col("_v")).alias("_v")).agg(
        F.count(F.lit(1)).alias("n")
    )
    upto = Window.partitionBy("_i").orderBy(F.col("_v").asc_nulls_first())
    ranked = counted.withColumn("_end", F.sum("n").over(upto)).withColumn(
        "_start", F.col("_end") - F.col("n")
    )
    wanted = spark.createDataFrame(
        [(label[g, lo, hi], r) for (g, r), (lo, hi) in found.items()], "_i int, _r bigint"
    )
    hits = ranked.join(F.broadcast(wanted), "_i").filter(
        "_start <= _r and _r < _end and _v is not null"
    )
    by_place = {(row["_i"], row["_r"]): row["_v"] for row in hits.select("_i", "_r", "_v").collect()}
    return {(g, r): by_place[label[g, lo, hi], r] for (g, r), (lo, hi) in found.items()}


def exact_percentiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> dict[str, dict[float, float | None]]:
    """Linearly interpolated percentiles of several columns in one go."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "_c", "_x"
    )
    counts: dict[str, int] = {}

    def ranks(column: str, n: int):
        counts[column] = n
        places = [(n - 1) * p for p in probs]
        return sorted({f(x) for x in places for f in (math.floor, math.ceil)})

    at = order_statistics(long, "_c", "_x", ranks)
    out: dict[str, dict[float, float | None]] = {}
    for c in columns:
        n = counts.get(c, 0)
        out[c] = {}
        for p in probs:
            if n == 0:
                out[c][p] = None
                continue
            place = (n - 1) * p
            low, high = at[c, math.floor(place)], at[c, math.ceil(place)]
            out[c][p] = low + (high - low) * (place - math.floor(place))
    return out


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    return {c: v[0.5] for c, v in exact_percentiles(df, columns, [0.5]).items()}


def top_cutoffs(
    df: DataFrame, group: str, value: str, share: float
) -> dict[str, tuple[float, int]]:
    """Per group: the value of the last row among the top ``share``, and how many."""
    sizes: dict[str, int] = {}

    def ranks(g: str, n: int):
        sizes[g] = max(1, int(n * share))
        return [n - sizes[g]]

    at = order_statistics(df, group, value, ranks)
    return {g: (v, sizes[g]) for (g, _), v in at.items()}
