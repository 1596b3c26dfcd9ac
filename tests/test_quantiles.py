import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from hearthscore.operators import quantiles as q
from hearthscore.operators.ordered import with_running


def test_percentiles_interpolate(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, None), (3.0, 7.0), (4.0, None)], "a double, b double")
    out = q.exact_percentiles(df, ["a", "b"], [0.25, 0.5])
    assert out["a"] == {0.25: 1.75, 0.5: 2.5}
    assert out["b"][0.5] == 6.0


def test_empty_column_has_no_median(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    assert q.exact_medians(df, ["a", "b"]) == {"a": 1.0, "b": None}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-50, 50), min_size=1, max_size=60), p=st.floats(0, 1))
def test_percentiles_match_numpy(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "a double")
    got = q.exact_percentiles(df, ["a"], [p])["a"][p]
    assert got == pytest.approx(np.quantile(values, p))


@pytest.mark.parametrize("heavy", [False, True])
def test_narrowing_passes_stay_exact(spark, monkeypatch, heavy):
    """Small interval limit, so that several narrowing passes run."""
    monkeypatch.setattr(q, "MAX_INTERVAL_ROWS", 40)
    n = 20000
    value = F.pmod(F.col("id") * 7919, F.lit(n)).cast("double")
    if heavy:  # a third of the rows share one value
        value = F.when(F.col("id") % 3 == 0, 777.0).otherwise(value)
    df = spark.range(n).select(value.alias("a"), (F.col("id") % 2).cast("string").alias("g"))
    data = {g: sorted(r.a for r in df.filter(F.col("g") == g).collect()) for g in ("0", "1")}
    ranks = [0, 17, 3333, 5000, 9999]
    got = q.order_statistics(df, "g", "a", lambda g, c: ranks)
    assert got == {(g, r): data[g][r] for g in data for r in ranks}


def test_running_sums_over_slices_with_a_heavy_value(spark):
    n = 5000
    p = F.when(F.col("id") % 3 == 0, 0.5).otherwise((F.col("id") * 31 % 997) / 997)
    df = spark.range(n).select("id", p.alias("p"), (F.col("id") % 5).alias("v"))
    out = with_running(df, ["-p", "id"], {"total": "v"}, slices=16)
    rows = sorted(out.collect(), key=lambda r: (-r.p, r.id))
    assert [r.position for r in rows] == list(range(1, n + 1))
    assert [r.total for r in rows] == list(np.cumsum([r.v for r in rows]))
    # the repeated value really is spread over several slices
    cut = df.repartitionByRange(16, F.desc("p"), F.col("id")).filter("p = 0.5")
    assert cut.select(F.spark_partition_id()).distinct().count() > 2


def test_longs_beyond_the_precision_of_doubles(spark, monkeypatch):
    rng = random.Random(4)
    top = 2**60 - 1
    groups = {
        "small": [rng.randrange(top) for _ in range(150)],
        "wide": [rng.randrange(top) for _ in range(5000)],
        "tied": [top - 2] * 3000 + [top - 1] * 2000,
        "close": [top - i % 700 for i in range(3000)],
        "signed": [-(2**63), *(-rng.randrange(top) for _ in range(400)), 2**63 - 1],
        "one": [top - 5],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v long").persist()
    for limit in (q.MAX_INTERVAL_ROWS, 50):
        monkeypatch.setattr(q, "MAX_INTERVAL_ROWS", limit)
        wanted = {g: sorted({0, len(v) // 7, len(v) // 2, len(v) - 1}) for g, v in groups.items()}
        got = q.order_statistics(df, "g", "v", lambda g, n: wanted[g])
        assert got == {(g, r): sorted(groups[g])[r] for g, rs in wanted.items() for r in rs}
    df.unpersist()


@pytest.mark.parametrize("slices", [1, 2, 7, 40])
def test_running_sums_with_nulls_nans_and_one_hot_value(spark, slices):
    rng = np.random.default_rng(3)
    values = [None, float("nan"), 1.0, 1.0, 1.0, -2.5, float("inf")]
    rows = [(i, values[rng.integers(len(values))], "ab"[i % 2], int(rng.integers(9))) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, p double, g string, v long").repartition(5)
    for order, plain in ((["g", "-p", "id"], [F.col("g"), F.desc("p"), F.col("id")]),
                         (["p", "-id"], [F.col("p"), F.desc("id")])):
        whole = Window.orderBy(*plain)
        want = df.select("id", F.row_number().over(whole).alias("n"),
                         F.sum("v").over(whole.rowsBetween(Window.unboundedPreceding, 0)).alias("t"))
        got = with_running(df, order, {"t": "v"}, "n", slices).select("id", "n", "t")
        assert sorted(got.collect()) == sorted(want.collect())
    assert with_running(df.limit(0), ["p", "id"], {"t": "v"}, "n", slices).count() == 0


def test_running_sums_exchange_the_rows_once(spark):
    df = spark.range(5000).selectExpr("id", "cast(id % 11 as double) as p", "id % 3 as v").repartition(3)
    out = with_running(df, ["-p", "id"], {"t": "v"}, slices=8)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "WriteFiles" not in plan and plan.count("Window") == 2  # rows, and one row per slice
    physical = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in physical
