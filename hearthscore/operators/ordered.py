"""Global row numbers and running sums without one big sorted partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

MOST_SLICES = 512  # the slice of a row is found by a decision of depth log2 of this
DRAWN = 64  # sampled rows per slice that the splitters are taken from


def sort_columns(order: Sequence[str]) -> list[Column]:
    """Sort expressions for column names, ``-name`` for falling order."""
    return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order]


def _before(order: Sequence[str], split: Row) -> Column:
    """Whether a row sorts before ``split``; nulls first when rising, last when falling."""
    out = F.lit(False)
    for c in reversed(order):
        name = c.removeprefix("-")
        value, at = F.col(name), F.lit(split[name])
        if c.startswith("-"):
            ahead = value.isNotNull() & (at.isNull() | F.coalesce(value > at, F.lit(False)))
        else:
            ahead = at.isNotNull() & (value.isNull() | F.coalesce(value < at, F.lit(False)))
        out = ahead | (value.eqNullSafe(at) & out)
    return out


def slice_of(order: Sequence[str], splits: Sequence[Row], first: int = 0) -> Column:
    """The number of splitters that do not sort after the row, by halving."""
    if not splits:
        return F.lit(first)
    middle = len(splits) // 2
    low = slice_of(order, splits[:middle], first)
    high = slice_of(order, splits[middle + 1 :], first + middle + 1)
    return F.when(_before(order, splits[middle]), low).otherwise(high)


def splitters(df: DataFrame, order: Sequence[str], slices: int) -> list[Row]:
    """Evenly spaced rows of a bounded random sample, in order."""
    names = [c.removeprefix("-") for c in order]
    drawn = df.select(*names).orderBy(F.rand(1)).limit(DRAWN * slices).orderBy(*sort_columns(order)).collect()
    places = sorted({len(drawn) * i // slices for i in range(1, slices)} - {0})
    return [drawn[i] for i in places if i < len(drawn)]


def with_running(
    df: DataFrame,
    order: Sequence[str],
    sums: dict[str, str],
    position: str = "position",
    slices: int | None = None,
) -> DataFrame:
    """Add a 1-based global ``position`` and running totals in ``order``.

    ``order`` names columns (``-name``: falling); ``sums`` maps new column ->
    summed column.  Splitters become constants of the plan, so a row's slice is a
    comparison that gives the same slice whenever it is computed again; any
    splitters give the same result.  Slice totals (one row per slice) become
    offsets, and one exchange by slice is all that moves.  ``order`` must be
    total: with a unique last key even a heavily repeated value spans several
    slices.
    """
    spark = df.sparkSession
    slices = slices or min(MOST_SLICES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cut = df.withColumn("_slice", slice_of(order, splitters(df, order, slices)))
    totals = cut.groupBy("_slice").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(c).alias(f"_t_{name}") for name, c in sums.items()],
    )
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_slice",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        *[
            F.coalesce(F.sum(f"_t_{name}").over(before), F.lit(0)).alias(f"_before_{name}")
            for name in sums
        ],
    )
    rows = Window.partitionBy("_slice").orderBy(*sort_columns(order))
    upto = rows.rowsBetween(Window.unboundedPreceding, 0)
    helper = ["_slice", "_rows_before", *[f"_before_{n}" for n in sums]]
    numbered = cut.withColumns(
        {position: F.row_number().over(rows), **{name: F.sum(c).over(upto) for name, c in sums.items()}}
    )
    return (
        numbered.join(F.broadcast(offsets), "_slice")
        .withColumns(
            {
                position: F.col(position) + F.col("_rows_before"),
                **{name: F.col(name) + F.col(f"_before_{name}") for name in sums},
            }
        )
        .drop(*helper)
    )
