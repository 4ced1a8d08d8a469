"""Every query against its SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
import check
from reviewloom.queries import ALL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return check.connect(SF)


@pytest.mark.parametrize("name", list(ALL))
def test_query(spark, db, name):
    ok, note = check.compare(spark, db, SF, name)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
