"""Audits and exploratory summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthscore.config import FLAG_SUFFIX, Settings, products_in
from hearthscore.functions.encode import band_value, yes_no
from hearthscore.operators.quantiles import exact_medians, exact_percentiles


# --- missing values and grain -------------------------------------------------


def audit_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing count and percent of every column that has missing values, most first; one pass."""
    columns = list(columns or df.columns)
    filled = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in columns])
    missing = F.col("_n") - F.col("filled")
    return (
        filled.unpivot(["_n"], columns, "column_name", "filled")
        .select(
            "column_name",
            missing.alias("missing_count"),
            F.round(F.lit(100.0) * missing / F.col("_n"), 2).alias("missing_pct"),
        )
        .filter("missing_count > 0")
        .orderBy(F.desc("missing_count"), "column_name")
    )


def top_missing(df: DataFrame, n: int = 25) -> DataFrame:
    return audit_missing(df).orderBy(F.desc("missing_pct"), "column_name").limit(n)


def grain_report(df: DataFrame) -> DataFrame:
    """Rows, members, households and columns of the raw table."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("member_key").alias("n_members"),
        F.count_distinct("household_key").alias("n_households"),
        F.lit(len(df.columns)).alias("n_columns"),
    )


def per_column(
    df: DataFrame, columns: Sequence[str], measures: Callable[[Column], dict[str, Column]]
) -> DataFrame:
    """A row per column with its measures, from one aggregate over rows as they are.

    ``measures`` gives named aggregates of a column, taken as doubles.  Each task
    sends one wide row; nothing is unpivoted before the sums.
    """
    found = {c: measures(F.col(f"`{c}`").cast("double")) for c in columns}
    wide = df.agg(
        *[m.alias(f"{name}_{i}") for i, found_in in enumerate(found.values()) for name, m in found_in.items()]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{name}_{i}").alias(name) for name in found_in])
        for i, (c, found_in) in enumerate(found.items())
    ]
    return wide.select(F.inline(F.array(*rows)))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column."""
    quartiles = exact_percentiles(df, columns, [0.25, 0.5, 0.75])
    table = df.sparkSession.createDataFrame(
        [(c, q[0.25], q[0.5], q[0.75]) for c, q in quartiles.items()],
        "column_name string, q25 double, q50 double, q75 double",
    )
    stats = per_column(
        df,
        columns,
        lambda x: {
            "n": F.count(x),
            "mean": F.avg(x),
            "std": F.stddev_samp(x),
            "min": F.min(x),
            "max": F.max(x),
        },
    )
    return stats.join(F.broadcast(table), "column_name")


def rows_per_member(df: DataFrame) -> DataFrame:
    counts = df.groupBy("member_key").agg(F.count(F.lit(1)).alias("rows"))
    return describe(counts, ["rows"])


def with_share(counts: DataFrame, n: str = "n", digits: int | None = None) -> DataFrame:
    """Add each row's share of the total; for short tables of counts."""
    share = F.col(n) / F.sum(n).over(Window.partitionBy())
    return counts.withColumn("share", share if digits is None else F.round(share, digits))


def status_distribution(members: DataFrame) -> DataFrame:
    """Members per status; ``members`` holds one row per member."""
    return with_share(members.groupBy("member_status").agg(F.count(F.lit(1)).alias("n")))


# --- product holdings ---------------------------------------------------------


def _flags(df: DataFrame) -> dict[str, Column]:
    return {p: yes_no(p + FLAG_SUFFIX) for p in products_in(df.columns)}


def household_holdings(members: DataFrame) -> DataFrame:
    """0/1 per household and product; members without a household and
    households without any known flag drop out.
    """
    flags = _flags(members)
    held = members.filter("household_key is not null").groupBy("household_key").agg(*[F.max(f).alias(p) for p, f in flags.items()])
    return held.na.drop("all", subset=list(flags))


def product_rates(df: DataFrame, products: Sequence[str]) -> DataFrame:
    """Holders and penetration per product, from one pass over 0/1 columns."""
    sums = df.agg(
        *[
            F.struct(F.coalesce(F.sum(p), F.lit(0)).alias("s"), F.count(p).alias("n")).alias(p)
            for p in products
        ]
    )
    long = sums.unpivot([], list(products), "product", "v")
    return long.select(
        "product",
        F.try_divide(F.col("v.s").cast("double"), F.col("v.n")).alias("penetration"),
        F.col("v.s").alias("positives"),
    )


def modelable_products(df: DataFrame, products: Sequence[str], settings: Settings) -> DataFrame:
    """Products with enough penetration and enough holders to learn from."""
    return product_rates(df, [p for p in products if p in df.columns]).filter(
        (F.col("penetration") >= settings.min_penetration)
        & (F.col("positives") >= settings.min_positives)
    )


def adoption_by_usage(members: DataFrame) -> DataFrame:
    """Holding rate per product for members with and without a dated call."""
    flags = _flags(members)
    wide = members.groupBy(F.col("sc_date").isNotNull().cast("int").alias("has_used_ers")).agg(
        *[F.avg(f).alias(p) for p, f in flags.items()]
    )
    return wide.unpivot(["has_used_ers"], list(flags), "product", "rate")


def product_depth(holdings: DataFrame, products: Sequence[str]) -> DataFrame:
    """Households by number of products held, with share and running share."""
    depth = sum((F.coalesce(F.col(p), F.lit(0)) for p in products), F.lit(0))
    counts = holdings.groupBy(depth.alias("depth")).agg(F.count(F.lit(1)).alias("households"))
    everything = Window.partitionBy()
    upto = Window.orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("households").over(everything)
    return counts.withColumns(
        {
            "share": F.col("households") / total,
            "cumulative": F.sum("households").over(upto) / total,
        }
    )


def depth_summary(depth: DataFrame) -> DataFrame:
    total = F.sum("households")
    return depth.agg(
        (F.sum(F.when(F.col("depth") == 0, F.col("households")).otherwise(0)) / total).alias(
            "no_product"
        ),
        (F.sum(F.when(F.col("depth") >= 2, F.col("households")).otherwise(0)) / total).alias(
            "two_or_more"
        ),
    )


def income_by_buyer(members: DataFrame, bands: dict[str, int]) -> DataFrame:
    """Income box-plot figures for holders and non-holders of each product.

    Members collapse to counts per (product, flag, income midpoint), a few
    hundred rows, before any percentile is taken.
    """
    flags = _flags(members)
    counts = (
        members.select(band_value("income", bands).alias("income"), *[f.alias(p) for p, f in flags.items()])
        .filter("income is not null")
        .unpivot(["income"], list(flags), "product", "buyer")
        .filter("buyer is not null")
        .groupBy("product", "buyer", "income")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    box = (
        counts.groupBy("product", "buyer")
        .agg(F.sum("n").alias("members"), F.percentile("income", [0.25, 0.5, 0.75], F.col("n")).alias("q"))
        .select(
            "product",
            "buyer",
            "members",
            F.col("q")[0].alias("q1"),
            F.col("q")[1].alias("median"),
            F.col("q")[2].alias("q3"),
        )
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("income").between(F.col("q1") - reach, F.col("q3") + reach)
    ends = (
        counts.join(box, ["product", "buyer"])
        .groupBy("product", "buyer")
        .agg(
            F.min(F.when(inside, F.col("income"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("income"))).alias("whisker_high"),
            F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("outliers"),
        )
    )
    return box.join(ends, ["product", "buyer"])


# --- cost ---------------------------------------------------------------------


def cost_nonzero(df: DataFrame, cost: str = "total_cost") -> DataFrame:
    return df.filter(F.col(cost) > 0)


def histogram(df: DataFrame, columns: Sequence[str], bins: int) -> DataFrame:
    """Equal-width bins between each column's extremes, the maximum in the last.

    Two passes for any number of columns: extremes, then counts per bin.
    """
    columns = list(columns)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "x"
    ).filter("x is not null")
    ends = long.groupBy("column_name").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    ends = F.broadcast(
        df.sparkSession.createDataFrame(
            [(r.column_name, r.lo, r.hi, r.hi - r.lo or 1.0) for r in ends.collect()],
            "column_name string, lo double, hi double, width double",
        )
    )
    place = F.floor((F.col("x") - F.col("lo")) / F.col("width") * F.lit(bins))
    counts = (
        long.join(ends, "column_name")
        .groupBy("column_name", F.least(place, F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = ends.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))))
    return frame.join(F.broadcast(counts), ["column_name", "bin"], "left").select(
        "column_name",
        "bin",
        (F.col("lo") + F.col("bin") * (F.col("width") / F.lit(bins))).alias("low"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def cost_histogram(df: DataFrame, cost: str = "total_cost", bins: int = 60) -> DataFrame:
    """Non-zero cost, raw and after log(1 + x)."""
    paid = cost_nonzero(df, cost).select(F.col(cost).cast("double").alias("raw"))
    out = histogram(paid.withColumn("log1p", F.log1p("raw")), ["raw", "log1p"], bins)
    return out.withColumnRenamed("column_name", "scale")


def zero_inflation(df: DataFrame) -> DataFrame:
    """Members without any cost: over all calls, and over dated calls only."""
    dated = F.sum(F.when(F.col("sc_date").isNotNull(), F.col("total_cost")))
    per_member = df.groupBy("member_key").agg(
        F.coalesce(F.sum("total_cost"), F.lit(0)).alias("every"),
        F.coalesce(dated, F.lit(0)).alias("dated"),
    )
    return per_member.agg(
        F.count(F.lit(1)).alias("members"),
        F.avg((F.col("every") == 0).cast("int")).alias("zero_share"),
        F.avg((F.col("dated") == 0).cast("int")).alias("zero_share_dated"),
    )


def cost_profile(df: DataFrame, cost: str) -> DataFrame:
    """Zero share, and mean and median of what is not zero."""
    x = F.col(cost)
    paid = F.when(x > 0, x)
    median = exact_medians(df.select(paid.cast("double").alias("paid")), ["paid"])["paid"]
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((x == 0).cast("int")).alias("zero_share"),
        F.try_divide(F.sum(paid).cast("double"), F.count(paid)).alias("mean_nonzero"),
    ).withColumn("median_nonzero", F.lit(median).cast("double"))


# --- correlation --------------------------------------------------------------


def _means_and_variances(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    rows = per_column(df, columns, lambda x: {"mean": F.avg(x), "var": F.var_samp(x)}).collect()
    return {r.column_name: (r.mean, r["var"]) for r in rows if r["var"] is not None}


def _by_variance(known: dict[str, tuple], n: int) -> list[str]:
    return sorted(known, key=lambda c: (-known[c][1], c))[:n]


def top_variance(df: DataFrame, columns: Sequence[str], n: int) -> list[str]:
    """The ``n`` columns with the largest sample variance."""
    return _by_variance(_means_and_variances(df, columns), n)


def correlation_matrix(df: DataFrame, columns: Sequence[str], n: int = 20) -> DataFrame:
    """Pairwise correlations of the most variable columns, lower triangle.

    Each Arrow batch yields the pair sums (count, x, y, xx, yy, xy) over rows
    where both are filled, as n x n matrix products of centred values; Spark adds
    them up.  As 190 separate aggregates the same sums take far longer.
    """
    known = _means_and_variances(df, columns)
    top = _by_variance(known, n)
    means = np.array([known[c][0] for c in top])
    lower = np.tril_indices(len(top), -1)

    def pair_sums(batches):
        for batch in batches:
            x = batch.to_numpy(dtype=float) - means
            there = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            yield pd.DataFrame(
                {
                    "a": lower[0],
                    "b": lower[1],
                    "n": (there.T @ there)[lower],
                    "x": (x.T @ there)[lower],
                    "y": (there.T @ x)[lower],
                    "xx": ((x * x).T @ there)[lower],
                    "yy": (there.T @ (x * x))[lower],
                    "xy": (x.T @ x)[lower],
                }
            )

    sums = ("n", "x", "y", "xx", "yy", "xy")
    schema = "a int, b int, " + ", ".join(f"{s} double" for s in sums)
    totals = (
        df.select(*[F.col(c).cast("double").alias(c) for c in top])
        .mapInPandas(pair_sums, schema)
        .groupBy("a", "b")
        .agg(*[F.sum(s).alias(s) for s in sums])
    )
    c = F.col
    cov = c("xy") - c("x") * c("y") / c("n")
    spread = (c("xx") - c("x") * c("x") / c("n")) * (c("yy") - c("y") * c("y") / c("n"))
    names = F.array(*[F.lit(name) for name in top])
    return totals.select(
        names[c("a")].alias("feature_a"),
        names[c("b")].alias("feature_b"),
        F.try_divide(cov, F.sqrt(spread)).alias("corr"),
    )


def target_correlation(
    df: DataFrame, columns: Sequence[str], target: str, n: int = 20, limit: float = 0.7
) -> DataFrame:
    """Columns most correlated with the target; a high value hints at leakage."""
    others = [c for c in columns if c != target]
    t = F.col(f"`{target}`").cast("double")

    def corr(x: Column) -> dict[str, Column]:
        known = F.when(x.isNotNull(), t)
        # Not corr(): it raises where a column is constant.
        spread = F.stddev_pop(F.when(t.isNotNull(), x)) * F.stddev_pop(known)
        return {"abs_corr": F.abs(F.try_divide(F.covar_pop(x, t), spread))}

    return (
        per_column(df, others, corr)
        .withColumnRenamed("column_name", "feature")
        .filter("abs_corr is not null")
        .withColumn("suspicious", F.col("abs_corr") > limit)
        .orderBy(F.desc("abs_corr"), "feature")
        .limit(n)
    )
