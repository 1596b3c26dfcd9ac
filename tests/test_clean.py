import pytest
from pyspark.sql import functions as F

from hearthscore import config
from hearthscore.functions.encode import number, slug
from hearthscore.operators import clean
from hearthscore.operators.explore import audit_missing, top_missing
from hearthscore.sources import calls as io


def rows(df, key):
    return {r[key]: r for r in df.collect()}


def test_fixed_tables_are_ordered_and_complete():
    assert len(config.INCOME_MIDPOINTS) == 15
    assert len(config.CREDIT_MIDPOINTS) == 8
    assert len(config.CHILDREN_COUNTS) == 7
    for table in (config.INCOME_MIDPOINTS, config.CREDIT_MIDPOINTS, config.CHILDREN_COUNTS):
        assert list(table.values()) == sorted(table.values())


def test_settings_are_consistent():
    s = config.Settings()
    assert s.test_share + s.validation_share < 1
    assert s.segments in s.segment_range
    assert 0 < s.min_penetration < 1


def test_ordinals_unknown_is_null_not_zero(raw_members):
    out = rows(clean.encode_ordinals(raw_members), "member_key")
    assert out[1].income == 55000 and out[2].income == 125000
    assert out[3].credit_ranges == 400 and out[4].credit_ranges is None
    assert out[4].income is None and out[4].number_of_children is None


def test_flags(raw_members):
    df = clean.encode_flags(raw_members)
    out = rows(df, "member_key")
    assert "alpha_flag" not in df.columns and "member_type" not in df.columns
    assert (out[1].alpha, out[2].alpha, out[3].beta) == (1, 0, 1)
    assert (out[1].mail_responder, out[2].mail_responder) == (1, 0)
    assert (out[2].primary_member, out[2].associate_member) == (0, 1)
    assert out[2].do_not_direct_mail_solicit == 1.0


def test_flags_are_case_sensitive_and_unknown_is_null(spark):
    df = spark.createDataFrame([("y",), ("Y",), ("maybe",), (None,)], "x_flag string")
    assert [r.x for r in clean.encode_flags(df).collect()] == [None, 1, None, None]


def test_numbers_and_slugs(spark):
    df = spark.createDataFrame([("1.5",), ("n/a",), (None,)], "t string")
    assert [r.v for r in df.select(number("t").alias("v")).collect()] == [1.5, None, None]
    named = spark.createDataFrame([("Big Item Flag",)], "t string")
    assert named.select(slug("t").alias("v")).first().v == "big_item"


def test_whitelist_and_exclusions(spark, raw_members):
    df = raw_members.withColumns({"race": F.lit("x"), "junk": F.lit(1)})
    kept = clean.select_whitelist(df)
    assert "junk" not in kept.columns and "race" not in kept.columns
    assert kept.columns[:2] == ["alpha_flag", "beta_flag"]
    with pytest.raises(ValueError, match="race"):
        clean.assert_no_excluded(df)
    audit = rows(clean.exclusion_audit(df), "column_name")
    assert (audit["race"].present, audit["race"].filled) == (1, 4)
    assert audit["cancel_date"].present == 0


def test_status_filter_drops_its_column(raw_calls):
    out = clean.filter_status(raw_calls)
    assert "member_status" not in out.columns
    assert out.count() == 6


def test_leakage_patterns():
    cols = ["cost_2014_sum", "ers_member_cost_year_1_mean", "avg_cost_per_call", "total_cost_sum",
            "cost_trend", "members", "total_ers_calls"]
    assert clean.leakage_columns(cols) == cols[:5]


def test_all_null_numeric_columns_go(spark):
    df = spark.createDataFrame([(1.0, None, True), (2.0, None, None)], "a double, b double, c boolean")
    assert clean.drop_all_null(df).columns == ["a", "c"]


def test_audit_missing(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 5)], "a int, b int")
    out = audit_missing(df).collect()
    assert [(r.column_name, r.missing_count, r.missing_pct) for r in out] == [("b", 2, 66.67)]
    assert audit_missing(df.select("a")).count() == 0
    assert top_missing(df, 1).first().column_name == "b"


def test_unmapped_values(raw_members):
    out = rows(clean.unmapped_values(raw_members), "column_name")
    assert out["credit_ranges"].unmapped == 1 and out["income"].unmapped == 0


def test_csv_scan_types_order_and_index(spark, tmp_path):
    path = tmp_path / "calls.csv"
    path.write_text(
        "Unnamed: 0,Member Key,Household Key,ZIP,Total Cost,SC Date,Alpha Flag\n"
        "0,m2,7,02101,12.50,2015-01-02,Y\n1,m1,8,02102,bad,not a date,N\n2,m2,7,,3.1,,N\n"
    )
    df = io.scan_csv(spark, str(path))
    assert df.columns == ["member_key", "household_key", "zip", "total_cost", "sc_date", "alpha_flag",
                          "file_order"]
    first, second, third = df.orderBy("file_order").collect()
    assert first.zip == "02101" and float(first.total_cost) == 12.5 and first.sc_date.year == 2015
    assert second.total_cost is None and second.sc_date is None
    assert third.zip is None
    assert config.products_in(df.columns) == ["alpha"]
