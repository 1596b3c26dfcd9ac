import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from hearthscore.session import local_session

    shared = tmp_path_factory.mktemp("shared")
    session = local_session("8", 4, **{"spark.checkpoint.dir": f"file://{shared}"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


@pytest.fixture(scope="session")
def raw_members(spark):
    """Four members in three households: shared flags, unknown bands, nulls."""
    flags = ["alpha", "beta"]
    rows = [
        (1, 100, "Y", "N", "50-59,999", "700-749", "No children", "Yes", "Y", "0", "Primary", 5.0, 8.0,
         "own", "02101", 1.0, 1.0, 0.0, 10.0, 20.0, 5.0, 65.0, 0),
        (2, 100, "N", "N", "100-149,999", "800+", "Two Children", "No", "N", "1", "Associate", 5.0, 3.0,
         "own", "02101", 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1),
        (3, 101, "N", "Y", "Under 10K", "499 & Less", "One Child", "Yes", "Y", "0", "Primary", 12.0, 15.0,
         None, "02102", 2.0, 1.0, 0.0, 60.0, 50.0, 0.0, 110.0, 2),
        (4, 102, "N", "N", None, "Unknown", None, "No", "N", "0", "Primary", 3.0, None,
         "rent", "02103", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 3),
    ]
    schema = (
        "member_key long, household_key long, " + ", ".join(f"{f}_flag string" for f in flags)
        + ", income string, credit_ranges string, number_of_children string, mail_responder string,"
        " email_available string, do_not_direct_mail_solicit string, member_type string,"
        " member_tenure_years double, length_of_residence double, home_owner string, zip string,"
        " ers_ent_count_year_1 double, ers_ent_count_year_2 double, ers_ent_count_year_3 double,"
        " ers_member_cost_year_1 double, ers_member_cost_year_2 double, ers_member_cost_year_3 double,"
        " total_cost double, file_order int"
    )
    return spark.createDataFrame(rows, schema)


CALL_SCHEMA = (
    "member_key string, household_key long, sc_date string, total_cost decimal(18,2),"
    " member_status string, zip string, alpha_flag string, file_order int"
)
CALLS = [
    ("a", 1, "2015-03-01", 10, "ACTIVE", "z1", "N", 0),
    ("a", 1, "2016-03-01", 20, "ACTIVE", "z2", "Y", 1),
    ("a", 1, None, 99, "ACTIVE", "z3", "N", 2),
    ("b", 1, "2015-05-01", 5, "CANCELLED", "z4", "Y", 3),
    ("b", 1, "2017-05-01", 7, "PENDING", "z5", "N", 4),
    ("c", 2, "2015-06-01", 3, "CANCELLED", "z6", "Y", 5),
    ("d", None, "2015-06-01", 4, "ACTIVE", "z7", "Y", 6),
    ("e", 3, None, 8, "ACTIVE", "z8", "Y", 7),
]


@pytest.fixture(scope="session")
def raw_calls(spark):
    """Several calls per member, a cancelled one, an undated one, a null household."""
    from decimal import Decimal

    from hearthscore.functions.encode import call_time

    rows = [(*r[:3], Decimal(r[3]), *r[4:]) for r in CALLS]
    df = spark.createDataFrame(rows, CALL_SCHEMA)
    return df.withColumn("sc_date", call_time("sc_date"))
