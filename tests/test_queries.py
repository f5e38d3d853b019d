"""Every query with SQL gives the rows of its SQL; every query runs on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry
from compare import check, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def core_names():
    from lacquer.plans import catalog

    return sorted(catalog.QUERIES)


@pytest.mark.parametrize("name", core_names())
def test_query(name, spark, con):
    good, said = check(name, spark, con, SF)
    assert good, said


def test_entry(spark):
    assert entry.entry(spark).columns == ["chunk_id", "block", "score"]


def test_flagship_plan_has_no_cartesian_product(spark):
    plan = entry.queries()["glossary_block"](spark, SF)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "ArrowEvalPython" not in plan
