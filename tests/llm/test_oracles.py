"""Each query of this subpackage that has SQL, against DuckDB."""

import pytest

from conftest import SF01
from oracle import compare, duck
from tessera.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    problems = compare(QUERIES[name](spark, SF01), duck(SF01), ORACLE_SQL[name])
    assert not problems, problems
