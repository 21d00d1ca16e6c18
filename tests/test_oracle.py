"""Every registered key against its DuckDB SQL on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from scripts.oracle_check import compare, duck_connection
from tally.queries import QUERIES as OWN

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

QUERIES = {k: v for k, v in entry.queries().items() if k in OWN}
SQL = {k: v for k, v in entry.oracle_sql().items() if k in OWN}


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


def test_every_key_has_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_key_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    assert compare(df, con, SQL[key]) == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "savings_rate" in df.columns
