import pytest

from leafmill.plans.oracles import ORACLES
from leafmill.plans.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(compare, name):
    mine, sql = compare(name)
    assert mine == sql


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
