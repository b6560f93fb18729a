"""Every registered query against its SQL, on the smallest data set."""

import os

import pytest

import __spark_entry__ as entry_point
from harness import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    own = {name for area in entry_point.AREAS if area.__name__.startswith("vaultrail.plans.") for name in area.QUERIES}
    assert own <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["action", "n"]


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query(spark, duck, name):
    frame = entry_point.queries()[name](spark, FOLDER)
    difference = compare(duck, frame, entry_point.oracle_sql()[name])
    assert difference is None, difference
