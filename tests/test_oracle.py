"""Every query of the warehouse against its SQL, at the smallest scale."""

import os

import pytest

from workload.compare import connect, difference
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR).toArrow()
    theirs = duck.sql(ORACLE[name]).to_arrow_table()
    assert difference(ours, theirs) is None
