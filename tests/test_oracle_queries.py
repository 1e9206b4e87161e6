"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate, run locally)."""

import pytest

import __spark_entry__ as E
from conftest import SF01
from oracle import compare, duck

ORACLES = [n for n in E.oracle_sql() if n != "pipeline" and not n.startswith("op")]


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF01)
    problems = compare(df, con, E.oracle_sql()[name])
    assert not problems, problems


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
