"""The numbered queries against their SQL; ORACLE_SF picks the tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import connect, differences  # noqa: E402

from gazette.llm.queries import ORACLES, QUERIES  # noqa: E402

SF_DIR = f"/root/testdata/sf{os.environ.get('ORACLE_SF', '0.001')}"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    found = differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert found is None, found


def test_every_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
