"""Every registered workload against its SQL text (DuckDB) on the smallest
tables, and the driver entry point."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from hopscope.workloads import ORACLE_SQL, QUERIES
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_workload_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_workload_matches_sql(spark, con, name):
    ok, msg = compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF)
    assert ok, msg


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["source", "lsp"]
    assert df.count() >= 0
