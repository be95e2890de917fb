"""Every query with SQL against DuckDB."""

import pytest
from compare import duck, same

from lectern.plans import registry

DONE_ELSEWHERE = {"p4_found", "p4_periods"}


@pytest.mark.parametrize("q", sorted(set(registry.oracle_sql()) - DONE_ELSEWHERE))
def test_oracle(spark, sf, q):
    same(registry.queries()[q](spark, sf), registry.oracle_sql()[q], duck(sf))


def test_every_query_has_sql_but_few():
    assert set(registry.queries()) - set(registry.oracle_sql()) <= {"outline_json"}
    assert set(registry.oracle_sql()) <= set(registry.queries())
