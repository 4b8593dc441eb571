"""Every registered query against its SQL; ORACLE_SF picks the tables."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from gazette.workload.catalogue import ORACLES, QUERIES

SF_DIR = f"/root/testdata/sf{os.environ.get('ORACLE_SF', '0.001')}"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(ORACLES) <= set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    found = differences(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name])
    assert found is None, found


def test_entry(spark):
    assert entry.entry(spark).count() > 0
