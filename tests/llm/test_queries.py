"""The registered queries of the subpackage: SQL where there is any, on the smallest tables."""

import os

import pytest

from __spark_entry__ import queries
from hopscope.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    ok, msg = compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF)
    assert ok, msg
