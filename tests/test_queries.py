"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import catalog

from .conftest import SF_DIR
from .oracle import compare, connect

# The corpus operators have tests of their own.
QUERIES, ORACLE = catalog.QUERIES, catalog.ORACLE


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    assert compare(QUERIES[name](spark, SF_DIR), db, ORACLE[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
