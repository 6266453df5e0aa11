"""Every registered query against its SQL, on the smallest tables."""

import pytest
from compare import compare, connect

from nightglass.plans import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name, QUERIES[name], ORACLE.get(name)) == ""


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
