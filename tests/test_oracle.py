"""Every named query against its SQL, on the smallest data set."""

import os
import re

import pytest

from oracle import connect, difference, spark_rows, sql_rows
from plumbline.workload import ORACLES, QUERIES

FOLDER = os.environ.get("SF_DIR", "/root/testdata/sf0.001")

# The line key repeats once in the smallest data set, which leaves the order of two rows open.
LARGER = {"permutation_importance", "evaluate_plan"}


@pytest.fixture(scope="module")
def duck():
    cache = {}

    def get(folder):
        if folder not in cache:
            cache[folder] = connect(folder)
        return cache[folder]

    return get


# No pairs of rows and no Python in the plan of any query.
FORBIDDEN = {
    "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
    "MapInPandas",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    folder = "/root/testdata/sf0.01" if name in LARGER else FOLDER
    df = QUERIES[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not FORBIDDEN & set(re.findall(r"[A-Z][A-Za-z]+", plan))
    problem = difference(spark_rows(df), sql_rows(duck(folder), ORACLES[name]))
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 4
