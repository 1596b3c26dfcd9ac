"""Every query that SQL can express, against DuckDB on the smallest tables."""

import pytest
from compare import compare, duck

from hearthscore.queries import ORACLE, QUERIES
from hearthscore.queries.modelling import TRAINED

# ``TRAINED`` needs products to train: tests/compare.py 0.01 checks those.
# No product of the smallest tables passes the thresholds.
EMPTY_WHEN_SMALL = {"modelable_products"}


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(set(ORACLE) - TRAINED))
def test_query_matches_sql(spark, con, sf, name):
    note = compare(spark, con, QUERIES[name], ORACLE[name], sf)
    if name in EMPTY_WHEN_SMALL:
        assert note in (None, "no rows on either side")
    else:
        assert note is None
