import pytest

import __spark_entry__ as entry
from conftest import SF
from oracle import connect, differences
from recordlake.plans.oracles import ORACLES
from recordlake.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_the_result_equals_the_sql(spark, con, name):
    assert differences(con, entry.queries()[name](spark, SF), entry.oracle_sql()[name]) is None


def test_the_flagship_query_runs(spark):
    assert entry.entry(spark).count() > 0
