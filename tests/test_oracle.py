"""Every registered query beside its SQL, on the smallest test tables."""

import pytest

from checks import ORACLES, QUERIES
from checks.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    problem, _ = compare(spark, db, QUERIES[name], ORACLES[name], SF_DIR)
    assert not problem
