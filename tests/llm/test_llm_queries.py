"""The queries that SQL can express, beside their SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest
from compare import difference, duck
from ticketmill.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    problem, _ = difference(spark, con, SF, queries.queries()[name], queries.oracle_sql()[name])
    assert problem is None, problem
