"""Every registered query against its SQL."""

import os

import pytest

from sampleledger.catalog import oracle_sql, queries
from tests.oracle import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_equal_to_sql(spark, con, key):
    assert compare(spark, con, SF_DIR, key) is None
