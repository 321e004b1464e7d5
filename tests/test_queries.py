"""Every registered query against its DuckDB statement on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from mercatura.plans import notices, retail
from oracle_check import compare, tables

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are absent")


@pytest.fixture(scope="module")
def con():
    return tables(SF_DIR)


OWN = {**retail.QUERIES, **notices.QUERIES}


def test_every_query_has_a_statement():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(OWN) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(OWN))
def test_query_equals_statement(spark, con, name):
    assert compare(spark, con, name, SF_DIR).startswith(("ok", "rows-only"))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
