import pytest

import __spark_entry__ as entry
from conftest import SF
from oracle import connect, differences
from recordlake.llm.queries import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_the_result_equals_the_sql(spark, name):
    assert differences(connect(SF), entry.queries()[name](spark, SF), entry.oracle_sql()[name]) is None


def test_all_are_registered():
    numbers = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert {f"op{i}" for i in range(1, 14)} <= numbers and "pipeline" in entry.queries()
