"""Every registered analytic with a SQL twin equals DuckDB on the sf 0.01 tables."""

import pytest

import __spark_entry__ as E
from compare import compare, duck
from paths import SF_CHECK

SQL = E.oracle_sql()
Q = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


def test_every_sql_twin_has_a_query():
    assert set(SQL) <= set(Q)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, con, name):
    problems, n = compare(Q[name](spark, SF_CHECK), con, SQL[name])
    assert not problems, problems
    assert n > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "output_6_hours_ahead" in df.columns
