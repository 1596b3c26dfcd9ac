"""Plan shape and skew: what has to hold when the data is large."""

from decimal import Decimal

from pyspark.sql import functions as F

from hearthscore.operators import explore as ex
from hearthscore.operators import household as hh
from hearthscore.operators import members as mb
from hearthscore.operators import metrics as mt
from hearthscore.queries import QUERIES
from hearthscore.sources import tpch_calls as src


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hot_calls(spark, n=30000):
    """A third of all calls belong to one member of one household."""
    hot = F.col("id") % 3 == 0
    member = F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("m"), (F.col("id") % 5000).cast("string")))
    return spark.range(n).select(
        member.alias("member_key"),
        F.when(hot, 0).otherwise(F.col("id") % 700 + 1).cast("bigint").alias("household_key"),
        F.lit("2015-01-01").cast("timestamp_ntz").alias("sc_date"),
        F.lit(Decimal("1.00")).cast("decimal(18,2)").alias("total_cost"),
        F.lit("ACTIVE").alias("member_status"),
        F.concat(F.lit("z"), (F.col("id") % 7).cast("string")).alias("zip"),
        F.lit("Y").alias("x_flag"),
        F.col("id").alias("file_order"),
    )


def shuffled_rows(df) -> list[int]:
    """Rows written by each shuffle of the executed plan."""
    df.collect()
    out = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name == "Exchange":
            m = node.metrics().get("shuffleRecordsWritten")
            if m.isDefined():
                out.append(m.get().value())
        if "QueryStage" in name:
            walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_dedup_reduces_in_the_map_tasks(spark):
    df = mb.dedup_first(hot_calls(spark).select("member_key", "file_order", "zip"))
    text = plan(df)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    rows = shuffled_rows(df)
    assert rows and max(rows) < 30000 - 9000  # the hot member's rows do not travel


def test_member_and_household_sums_reduce_in_the_map_tasks(spark):
    members = mb.encoded_members(hot_calls(spark), [2015])
    rows = shuffled_rows(members)
    assert len(rows) == 1 and rows[0] <= 30000 - 9000
    rolled = hh.household_rollup(members, ["x"])
    assert plan(rolled).count("Exchange") == 2
    hot = rolled.filter("household_key = 0").first()
    assert hot.members == 1 and hot.total_cost_sum == 10000


def test_hot_score_does_not_change_the_top_share(spark):
    n = 6000
    p = F.when(F.col("id") % 3 == 0, 0.9).otherwise((F.col("id") % 100) / 200)
    df = spark.range(n).select(F.col("id").alias("key"), F.lit(1).alias("y"), p.alias("p"))
    top = mt.mark_top_share(df, 0.1).filter("in_top")
    assert sorted(r.key for r in top.collect()) == [3 * i for i in range(600)]
    assert "Exchange hashpartitioning" not in plan(top)


def test_filter_and_columns_reach_the_scan(spark, sf):
    text = QUERIES["scan_parquet"](spark, sf)._jdf.queryExecution().toString()
    assert "PushedFilters: [" in text and "GreaterThan(o_totalprice,1000.0)" in text
    assert "o_orderpriority" not in text.split("Physical Plan")[1]


def test_raw_scan_is_pruned(spark, sf):
    df = src.raw_calls(spark, sf).select("member_key", "total_cost")
    scan = [l for l in plan(df).splitlines() if "lineitem.parquet" in l][0]
    assert "l_tax" not in scan and "l_discount" not in scan


def test_column_statistics_send_one_row_a_task(spark):
    """No row per column: sums are taken over the rows as they lie."""
    df = spark.range(0, 4000, 1, 8).select(*[(F.col("id") * i % 97).alias(f"c{i}") for i in range(1, 13)])
    found = ex.per_column(df, df.columns, lambda x: {"n": F.count(x), "mean": F.avg(x)})
    assert "Expand" not in plan(found) and plan(found).count("Exchange") == 1
    assert shuffled_rows(found) == [8]
    assert [r.n for r in found.collect()] == [4000] * 12
    assert "Expand" not in plan(ex.target_correlation(df, df.columns, "c1"))


def test_lines_meet_their_orders_last(spark, sf):
    """One exchange of joined lines, by order; customers join the orders."""
    from hearthscore.sources import tpch_calls as src

    quiet = spark.newSession()
    quiet.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = src.raw_calls(quiet, sf)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert len(joins) == 3 and "l_orderkey" in joins[0] and "o_orderkey" in joins[0]
    assert sum("o_custkey" in line and "c_custkey" in line for line in joins) == 1
    assert not any("hashpartitioning(o_custkey" in line and "l_" in line for line in plan.splitlines())


def test_scores_keep_only_their_columns_of_the_household_table(spark, sf):
    from hearthscore.queries.catalog import households

    whole, some = households(spark, sf), households(spark, sf, "household_key", "economy")
    assert some.columns == ["household_key", "economy"]
    assert sorted(some.collect()) == sorted(whole.select(*some.columns).collect())


def test_members_of_grouped_calls_need_no_exchange_of_their_own(spark, sf):
    """Lines lie by order after the last join, and a member is of one order."""
    quiet = spark.newSession()
    quiet.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plain, grouped = src.raw_calls(quiet, sf), src.raw_calls(quiet, sf, grouped=True)
    for build in (lambda df: mb.encoded_members(df, src.COST_YEARS), lambda df: mb.cost_pivot(df, src.COST_YEARS)):
        apart, together = build(plain), build(grouped)
        assert plan(together).count("Exchange hashpartitioning") == plan(apart).count("Exchange hashpartitioning") - 1
        assert together.columns == apart.columns
        assert together.exceptAll(apart).isEmpty() and apart.exceptAll(together).isEmpty()
