"""Every named query equals its SQL on the smallest sample."""

from __future__ import annotations

import os

import pytest
from compare import duck, duck_rows, spark_rows

from tapewarden.catalog import all_oracles, all_queries

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    got = spark_rows(QUERIES[name](spark, FOLDER))
    assert got == duck_rows(connection, ORACLES[name])
