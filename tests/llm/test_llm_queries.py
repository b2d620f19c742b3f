"""Registered queries with SQL against DuckDB, over whole tables."""

import os

import pytest
from compare import duck, duck_rows, spark_rows

from sievelake.llm.oracle import ORACLES
from sievelake.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) - set(ORACLES) == {"op4_decontamination", "op8_token_files", "op9_quality_classifier"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, connection, name):
    types, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    wanted_types, wanted_rows = duck_rows(connection, ORACLES[name])
    assert types == wanted_types
    assert rows == wanted_rows
    assert rows
