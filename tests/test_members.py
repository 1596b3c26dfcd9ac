from decimal import Decimal

from pyspark.sql import functions as F

from hearthscore.operators import clean
from hearthscore.operators import household as hh
from hearthscore.operators import members as mb
from hearthscore.operators.features import engineer_features, regression_target

YEARS = [2015, 2016, 2017]


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_undated_cost_is_in_year_zero_and_not_in_the_total(raw_calls):
    years = {(r.member_key, r.call_year): r.cost for r in mb.cost_by_year(raw_calls).collect()}
    assert years["a", 0] == 99
    wide = by(mb.cost_pivot(raw_calls, YEARS), "member_key")
    assert wide["a"].total_cost == 30 and wide["a"].cost_2015 == 10
    assert wide["e"].total_cost == 0


def test_cost_years(raw_calls):
    assert mb.cost_years(raw_calls) == YEARS


def test_dedup_keeps_the_first_row_of_the_order(raw_calls):
    first = by(mb.dedup_first(raw_calls), "member_key")
    assert {k: r.zip for k, r in first.items()} == {"a": "z1", "b": "z4", "c": "z6", "d": "z7", "e": "z8"}


def test_costs_come_from_all_calls_but_attributes_from_kept_ones(raw_calls):
    """Costs before deduplication and before the status filter."""
    out = by(mb.encoded_members(raw_calls, YEARS), "member_key")
    assert set(out) == {"a", "b", "d", "e"}  # c is cancelled throughout
    assert out["b"].zip == "z5" and out["b"].total_cost == Decimal(12)
    assert out["a"].alpha == 0


def test_one_shuffle_form_equals_the_separate_steps(raw_calls):
    kept = mb.dedup_first(clean.filter_status(clean.select_whitelist(raw_calls)))
    joined = mb.member_costs(kept, mb.cost_pivot(raw_calls, YEARS))
    want = clean.encode_flags(clean.encode_ordinals(joined)).drop("file_order")
    got = mb.encoded_members(raw_calls, YEARS).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_null_households_are_left_out(raw_calls):
    members = mb.encoded_members(raw_calls, YEARS)
    assert {r.household_key for r in hh.household_size(members).collect()} == {1, 3}


def test_mode_ties_take_the_lowest_and_missing_competes(spark):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (2, None), (2, None), (2, "x"), (3, "Q"), (3, None)],
        "household_key long, zip string",
    )
    out = {r.household_key: r.zip for r in hh.household_mode(df).collect()}
    assert out == {1: "a", 2: "Not Set", 3: "Not Set"}


def test_rollup_and_features(raw_members):
    members = clean.encode_flags(clean.encode_ordinals(raw_members))
    rolled = hh.household_rollup(members, ["alpha", "beta"])
    out = by(engineer_features(rolled, ["alpha", "beta"]), "household_key")
    h = out[100]
    assert h.members == 2 and h.alpha == 1 and h.beta == 0
    assert h.total_ers_calls == 3 and out[101].total_ers_calls == 3 and out[102].total_ers_calls == 0
    assert h.total_cost_sum == 65 and h.income_mean == 90000
    assert abs(h.avg_cost_per_call - 65 / 3.001) < 1e-9
    assert out[101].is_long_term_member == 1 and h.is_long_term_member == 0
    assert out[102].has_used_ers == 0 and out[102].income_mean is None
    assert h.is_high_income == 1 and out[102].is_high_income == 0
    assert h.product_count == 1 and h.is_multi_product == 0


def test_parts_joined_outer_equal_the_rollup(raw_members):
    m = clean.encode_flags(clean.encode_ordinals(raw_members))
    whole = hh.household_rollup(m, ["alpha"])
    parts = hh.household_outer(
        hh.household_mode(m), hh.household_size(m), hh.household_mean(m), hh.household_calls(m),
        hh.household_cost(m), hh.household_flags(m, ["alpha"]),
    ).select(*whole.columns)
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))


def test_sums_of_nothing_are_zero(spark):
    df = spark.createDataFrame(
        [(1, None)], "household_key long, ers_ent_count_year_1 double"
    )
    row = hh.household_calls(df).first()
    assert row.ers_ent_count_year_1_sum == 0 and row.ers_ent_count_year_1_mean is None


def test_regression_target(spark):
    df = spark.createDataFrame([(1, None)], "household_key long, total_cost_x double")
    assert regression_target(df).first().target == 0


def test_a_year_that_is_not_listed_counts_in_the_total(raw_calls):
    wide = by(mb.cost_pivot(raw_calls, [2015]), "member_key")
    assert wide["a"].cost_2015 == 10 and wide["a"].total_cost == 30
    out = by(mb.encoded_members(raw_calls, [2015]), "member_key")
    assert out["a"].total_cost == 30 and out["e"].total_cost == 0


def test_members_without_a_household_hold_nothing(raw_calls):
    from hearthscore.operators.explore import household_holdings

    assert None not in {r.household_key for r in household_holdings(raw_calls).collect()}


def test_household_keys_once_held_as_float_survive(spark, tmp_path):
    from hearthscore.sources.calls import scan_csv

    (tmp_path / "calls.csv").write_text('Member Key,Household Key,ZIP\n1,123.0,"a ""b"""\n2,124,c\n')
    rows = scan_csv(spark, f"file://{tmp_path}/calls.csv").collect()
    assert [(r.household_key, r.zip) for r in rows] == [(123, 'a "b"'), (124, "c")]


def test_flags_and_sums_in_one_pass_equal_the_separate_ones(spark):
    """Members whose calls lie in several households, ties in the order, nulls; one pass over the calls."""
    rows = [
        ("a", 7, 1, "ACTIVE", "N", 5, 2), ("a", 7, 2, "ACTIVE", "Y", 9, 1), ("a", 7, 1, "CANCELLED", "Y", 3, 0),
        ("b", 8, 1, "PENDING", "Y", None, 1), ("b", 8, 1, "PENDING", "N", 4, 1), ("b", 8, 2, "ACTIVE", "N", 6, 1),
        ("c", 9, 3, "ACTIVE", "Y", 2, 4), ("c", 9, None, "ACTIVE", "N", 1, 5), ("d", 9, 4, "ACTIVE", "Y", 8, 3),
        ("d", 9, None, "ACTIVE", "Y", 8, None), ("e", 9, 5, "CANCELLED", "Y", 8, 3),
    ]
    calls = spark.createDataFrame(
        rows, "member_key string, member_group int, household_key long, member_status string, alpha_flag string,"
        " total_cost int, file_order int"
    ).withColumn("sc_date", F.to_date(F.lit("2015-01-01")))
    flags = hh.household_rollup(mb.encoded_members(calls, []), ["alpha"]).select("household_key", "members", "alpha")
    kept = clean.filter_status(calls).groupBy("household_key").agg(F.count("*").alias("n"), F.sum("total_cost").alias("c"))
    want = flags.join(kept, "household_key")
    sums = {"n": F.count("*"), "c": F.sum("total_cost")}
    got = hh.household_rollup(mb.members_by_household(calls, sums), ["alpha"], ["n", "c"]).filter("members > 0")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_scores_read_the_lines_once(spark, sf):
    """Flags and shares of the scores come from the same pass over the calls."""
    from hearthscore.queries import evaluate

    plans = []
    original, evaluate.stage_table = evaluate.stage_table, lambda df, name: plans.append(df) or df
    try:
        evaluate.scores(spark, sf)
    finally:
        evaluate.stage_table = original
    plan = plans[-1]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1
