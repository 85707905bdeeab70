"""Every registered query against its SQL oracle (DuckDB) at sf0.001."""

import os

import pytest

import __spark_entry__ as entry
from histdim.plans.queries import QUERIES
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(entry.oracle_sql())))
def test_query_matches_oracle(spark, con, name):
    problems, _, _ = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert not problems, problems


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "customer_key" in df.columns
