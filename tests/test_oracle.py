"""Every registered query against its DuckDB oracle at sf0.001 (driver uses sf0.01)."""

import pytest
from oracle_compare import compare, duck

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], SQL[name], SF)
    assert r["cols_match"], r
    assert r["rows"][0] == r["rows"][1], r
    assert r["hash_match"], r
    assert not r["type_diff"], r


def test_every_query_has_a_callable():
    assert set(SQL) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["kkey", "rows"]
