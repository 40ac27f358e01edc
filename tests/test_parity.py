"""Every registered query against its SQL on the smallest tables."""

import parity
import pytest

import __spark_entry__ as entry_module
from changeloom.workloads import oracle
from changeloom.workloads.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# The optional subpackage has tests of its own; a few of its queries have no SQL form.
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return parity.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert parity.difference(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).limit(1).count() == 1
