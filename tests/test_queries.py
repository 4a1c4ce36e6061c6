"""Every query of the library itself beside its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from compare import difference, duck
from ticketmill.workload import queries as own

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
REGISTERED, SQL = entry.queries(), entry.oracle_sql()
QUERIES = {name: REGISTERED[name] for name in own.queries()}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL) <= set(REGISTERED)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem, rows = difference(spark, con, SF, QUERIES[name], SQL[name])
    assert problem is None
    assert rows > 0


def test_flagship(spark):
    found = [tuple(r) for r in entry.entry(spark).collect()]
    assert [name for name, _ in found] == [
        "boards", "issues", "projects", "releases", "transitions"
    ]
