"""Binds the call-table domain onto the order/lineitem test tables.

One line is one call, ``(order, line number)`` is a member (not unique, so a
member has several calls) and the customer is the household.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthscore.config import CHILDREN_COUNTS, CREDIT_MIDPOINTS, INCOME_MIDPOINTS
from hearthscore.operators.clean import GROUP_COLUMN
from hearthscore.sources.calls import MONEY

TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
DENSE_PRODUCTS = tuple(t.lower() for t in TYPES)
SPARSE_PRODUCTS = ("sparse_r", "sparse_a", "sparse_n")
PRODUCTS = DENSE_PRODUCTS + SPARSE_PRODUCTS
COST_YEARS = tuple(range(1995, 2002))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, labels) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (index + 1).cast("int"))


def raw_calls(spark: SparkSession, sf_dir: str, grouped: bool = False) -> DataFrame:
    """All calls; ``grouped`` adds the order as the members' group, by which the joined lines lie."""
    # Customers join the orders, which are fewer than the lines, and the lines meet the
    # orders last: a household's calls of one order then lie together, so that sums by
    # household or member shrink before they are shuffled.
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    ordered = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    joined = line.join(part, F.col("l_partkey") == F.col("p_partkey")).join(
        ordered, F.col("l_orderkey") == F.col("o_orderkey")
    )
    c = F.col
    ship_year = F.year("l_shipdate")
    undated = (c("l_linenumber") == 7) & (c("l_returnflag") == "N")
    price = c("l_extendedprice").cast(MONEY)
    zero = F.lit(0).cast(MONEY)

    def yn(test: Column) -> Column:
        return F.when(test, "Y").otherwise("N")

    big_return = (c("l_quantity") >= 48) & (c("l_returnflag") == "R")
    rare = (c("p_size") == 50) & (c("l_quantity") == 50)
    flags = [yn((c("p_type") == t) & big_return).alias(f"{t.lower()}_flag") for t in TYPES]
    flags += [yn(rare & (c("l_returnflag") == x)).alias(f"sparse_{x.lower()}_flag") for x in "RAN"]

    income_labels = list(INCOME_MIDPOINTS)[:10]
    band = F.least(F.floor(c("c_acctbal") / 1000), F.lit(9))
    years = []
    for i in (1, 2, 3):
        hit = ship_year == 1998 + i
        years.append(F.when(hit, c("l_quantity")).otherwise(0.0).alias(f"ers_ent_count_year_{i}"))
        years.append(F.when(hit, price).otherwise(zero).alias(f"ers_member_cost_year_{i}"))

    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("member_key"),
        c("o_custkey").alias("household_key"),
        F.when(~undated, c("l_shipdate")).alias("sc_date"),
        price.alias("total_cost"),
        F.when(c("o_orderstatus") == "F", "ACTIVE")
        .when(c("o_orderstatus") == "P", "PENDING")
        .otherwise("CANCELLED")
        .alias("member_status"),
        F.when(c("o_orderstatus") == "O", "moved").alias("cancel_reason"),
        F.when(c("l_linenumber") == 1, "Primary").otherwise("Associate").alias("member_type"),
        *flags,
        F.when(c("c_acctbal") < 0, "Unknown")
        .otherwise(_pick(F.greatest(band, F.lit(0)), income_labels))
        .alias("income"),
        _pick(c("c_nationkey") % 9, [*CREDIT_MIDPOINTS, "Unknown"]).alias("credit_ranges"),
        _pick(c("l_orderkey") % 8, [*CHILDREN_COUNTS, "Seven Children"]).alias(
            "number_of_children"
        ),
        c("p_brand").alias("zip"),
        F.when(c("p_size") > 5, c("c_mktsegment")).alias("home_owner"),
        c("p_type").alias("dwelling_type"),
        c("o_orderpriority").alias("mosaic_household"),
        c("l_returnflag").alias("mosaic_global_household"),
        c("l_linestatus").alias("kcl_b_ind_mosaicsgrouping"),
        (2 * (2002 - F.year("o_orderdate"))).cast("double").alias("member_tenure_years"),
        F.when(c("p_size") < 45, c("p_size").cast("double")).alias("length_of_residence"),
        *years,
        _pick(c("l_suppkey") % 5, ["Yes", "No", "Y", "N", "?"]).alias("mail_responder"),
        _pick(c("l_partkey") % 3, ["Y", "N", "Maybe"]).alias("email_available"),
        _pick(c("l_suppkey") % 4, ["0", "1", "0", "n/a"]).alias("do_not_direct_mail_solicit"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey").alias("file_order"),
        *([c("l_orderkey").alias(GROUP_COLUMN)] if grouped else []),
    )


def document_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled score with ties: quality label against a length-based score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        F.col("doc_id").alias("key"),
        F.col("quality").alias("y"),
        ((F.col("n_chars") % 1000) / 1000.0).alias("p"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


def cost_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual line price against quantity times list price."""
    line = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("yhat"),
    )
