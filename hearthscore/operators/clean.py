"""Column selection, population filter and encoding of the raw rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthscore.config import (
    CHILDREN_COUNTS,
    COST_LEAKAGE,
    CREDIT_MIDPOINTS,
    EXCLUDED,
    FLAG_SUFFIX,
    INCOME_MIDPOINTS,
    KEEP_STATUS,
    MEMBER_COLUMNS,
    products_in,
)
from hearthscore.functions.encode import band_value, equals_flag, number, yes_no

ORDER_COLUMN = "file_order"
GROUP_COLUMN = "member_group"  # optional: determined by the member, and the rows may lie by it


def select_whitelist(df: DataFrame) -> DataFrame:
    """Product flags plus the known member columns, order and group, as far as present."""
    wanted = [c for c in df.columns if c.endswith(FLAG_SUFFIX)]
    wanted += [c for c in MEMBER_COLUMNS if c in df.columns]
    wanted += [c for c in (ORDER_COLUMN, GROUP_COLUMN) if c in df.columns]
    return df.select(*wanted)


def filter_status(df: DataFrame, keep=KEEP_STATUS) -> DataFrame:
    """Keep active and pending members; the status column goes away."""
    if "member_status" not in df.columns:
        return df
    return df.filter(F.col("member_status").isin(*keep)).drop("member_status")


def exclusion_audit(df: DataFrame, excluded=EXCLUDED) -> DataFrame:
    """One row per forbidden column: is it in ``df``, and how often is it filled."""
    counts = [
        (F.count(name) if name in df.columns else F.lit(0)).cast("bigint").alias(name)
        for name in excluded
    ]
    present = F.create_map(
        *[x for name in excluded for x in (F.lit(name), F.lit(int(name in df.columns)))]
    )
    return (
        df.agg(*counts)
        .unpivot([], list(excluded), "column_name", "filled")
        .select("column_name", present[F.col("column_name")].alias("present"), "filled")
    )


def assert_no_excluded(df: DataFrame, excluded=EXCLUDED) -> DataFrame:
    found = [c for c in excluded if c in df.columns]
    if found:
        raise ValueError(f"forbidden columns in model input: {found}")
    return df


def leakage_columns(columns, patterns=COST_LEAKAGE) -> list[str]:
    return [c for c in columns if any(re.search(p, c) for p in patterns)]


def drop_leakage(df: DataFrame, patterns=COST_LEAKAGE) -> DataFrame:
    return df.drop(*leakage_columns(df.columns, patterns))


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def all_null_columns(df: DataFrame, columns=None) -> list[str]:
    """Columns without a single value, found in one pass."""
    columns = list(columns if columns is not None else numeric_columns(df))
    if not columns:
        return []
    filled = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    return [c for c in columns if filled[c] == 0]


def drop_all_null(df: DataFrame) -> DataFrame:
    return df.drop(*all_null_columns(df))


def encode_ordinals(df: DataFrame) -> DataFrame:
    """Income, credit and children labels to numbers; unknown labels to NULL."""
    tables = {
        "income": INCOME_MIDPOINTS,
        "credit_ranges": CREDIT_MIDPOINTS,
        "number_of_children": CHILDREN_COUNTS,
    }
    return df.withColumns({c: band_value(c, t) for c, t in tables.items() if c in df.columns})


def encode_flags(df: DataFrame) -> DataFrame:
    """Product flags to 1/0 under the product's name, other yes/no columns in place."""
    products = products_in(df.columns)
    new = {p: yes_no(p + FLAG_SUFFIX) for p in products}
    for c in ("mail_responder", "email_available"):
        if c in df.columns:
            new[c] = yes_no(c)
    if "do_not_direct_mail_solicit" in df.columns:
        new["do_not_direct_mail_solicit"] = number("do_not_direct_mail_solicit")
    if "member_type" in df.columns:
        new["primary_member"] = equals_flag("member_type", "Primary")
        new["associate_member"] = equals_flag("member_type", "Associate")
    return df.withColumns(new).drop("member_type", *[p + FLAG_SUFFIX for p in products])


def unmapped_values(df: DataFrame, tables=None) -> DataFrame:
    """How many filled values each label table does not know."""
    tables = tables or {
        "income": INCOME_MIDPOINTS,
        "credit_ranges": CREDIT_MIDPOINTS,
        "number_of_children": CHILDREN_COUNTS,
    }
    present = [c for c in tables if c in df.columns]
    counts = [F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*tables[c])).alias(c) for c in present]
    return df.agg(*counts).unpivot([], present, "column_name", "unmapped")
