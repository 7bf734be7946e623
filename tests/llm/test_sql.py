"""Queries that SQL can express equal it; all of them return a row for each document."""

from __future__ import annotations

import pytest
from compare import duck, duck_rows, spark_rows

from tapewarden.llm import all_oracles, all_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_equals_sql(spark, name):
    assert spark_rows(all_queries()[name](spark, FOLDER)) == duck_rows(duck(FOLDER), all_oracles()[name])


def test_every_operator_has_a_query():
    names = set(all_queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names} >= {f"op{k}" for k in range(1, 14)}
