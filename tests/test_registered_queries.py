"""Every registered query against its SQL, run by an independent engine over the same files."""

import os

import oracle
import pytest

import __spark_entry__ as entry_points
from silverloom import workloads

SF_DIRS = [d for d in ("/root/testdata/sf0.001", "/root/testdata/sf0.01") if os.path.isdir(d)]


@pytest.fixture(scope="module", params=SF_DIRS, ids=os.path.basename)
def scale(request):
    return request.param, oracle.connect(request.param)


def test_registry_is_complete():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(workloads.all_sql()) == set(workloads.all_queries())


@pytest.mark.parametrize("name", list(entry_points.oracle_sql()))
def test_query(spark, scale, name):
    sf_dir, con = scale
    result = entry_points.queries()[name](spark, sf_dir)
    assert oracle.compare(result, con, entry_points.oracle_sql()[name]) is None


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 8
    assert rows[0].avg_revenue >= rows[-1].avg_revenue
