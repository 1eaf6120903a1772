"""Every registered query beside its SQL on the smallest tables."""

import os

import oracle
import pytest

import __spark_entry__ as entry_points
from weirflow.plans.registry import all_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    query = all_queries()[name]
    frame = query(spark, FOLDER)
    if query.sql is None:
        assert frame.columns and frame.count() > 0
    else:
        assert oracle.compare(frame, con, query.sql) == []


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
