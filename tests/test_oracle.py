"""Every registered query against its DuckDB twin (or rows-only) on the smallest scale."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import compare, duck_conn

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con(small_dir):
    return duck_conn(small_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, small_dir, name):
    status, msg = compare(name, QUERIES[name], SQL.get(name), spark, con, small_dir)
    assert status in ("OK", "ROWS"), f"{name}: {status} {msg}"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "party_id"
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
