"""Every registered query against its oracle at the smallest scale; the rest must run."""

import os

import pytest

from cohortloom.plans import ORACLES, QUERIES
from tests.compare import differences, duck

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    if name in ORACLES:
        assert differences(got.columns, rows, con, ORACLES[name]) is None
    else:
        assert rows
