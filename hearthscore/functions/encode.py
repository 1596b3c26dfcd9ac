"""Text-to-number column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthscore.config import YES_NO


def band_value(column: str, bands: dict[str, int]) -> Column:
    """Look a label up in a small literal map; unknown or null labels give NULL."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(bands.items())])
    return F.try_element_at(table, F.col(column)).cast("double")


def yes_no(column: str) -> Column:
    """1/0 for the four accepted spellings (case-sensitive), else NULL."""
    out = None
    for label, number in YES_NO.items():
        hit = F.col(column) == label
        out = F.when(hit, number) if out is None else out.when(hit, number)
    return out.cast("int")


def number(column: str) -> Column:
    """Numeric value, or NULL when the text is not a number."""
    return F.col(column).try_cast("double")


def call_time(column: str) -> Column:
    """Timestamp, or NULL when the text is not one."""
    return F.col(column).try_cast("timestamp_ntz")


def call_year(column: str) -> Column:
    """Calendar year of the call; undated calls get year 0."""
    return F.coalesce(F.year(F.col(column)), F.lit(0))


def equals_flag(column: str, value: str) -> Column:
    """1 when equal, 0 otherwise (also for NULL)."""
    return F.coalesce((F.col(column) == value).cast("int"), F.lit(0))


def slug(column: Column | str) -> Column:
    """Lower case, blanks to underscores, without a trailing " Flag"."""
    col = F.col(column) if isinstance(column, str) else column
    return F.replace(F.lower(F.regexp_replace(col, " Flag$", "")), F.lit(" "), F.lit("_"))


def zero_if_null(column: Column | str) -> Column:
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(col, F.lit(0))


def mean_of(column: str) -> Column:
    """Mean as exact sum over count; money stays decimal until the division."""
    col = F.col(column)
    return F.try_divide(F.sum(col).cast("double"), F.count(col).cast("double"))
