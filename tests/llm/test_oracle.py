import pytest

from rainroute.checks.parity import compare, connect
from rainroute.llm.registry import ORACLE, REGISTRY


def test_sql_is_for_registered_queries():
    assert set(ORACLE) <= set(REGISTRY)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result_as_duckdb(spark, tiny, name):
    assert compare(connect(tiny), ORACLE[name], REGISTRY[name](spark, tiny)) is None
