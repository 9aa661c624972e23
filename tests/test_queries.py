import pytest

import __spark_entry__ as entrypoint
from tidewater.plans.oracles import ORACLES
from tidewater.plans.queries import QUERIES
from compare import differences, duck

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(entrypoint.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = entrypoint.queries()[name](spark, FOLDER)
    assert differences(df, con, entrypoint.oracle_sql()[name]) == []


def test_entry(spark):
    assert entrypoint.entry(spark).count() > 0
