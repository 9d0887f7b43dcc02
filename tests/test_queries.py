"""Every registered query beside its SQL on the smallest tables, and its plan."""

import os

import pytest
from compare import compare, duck

import __spark_entry__ as entry

SF = os.environ.get("SF", "/root/testdata/sf0.001")
# The queries of optional packages have tests of their own.
JOBS = {n: job for n, job in entry.queries().items() if job.__module__.startswith("suite")}
SQL = {n: sql for n, sql in entry.oracle_sql().items() if n in JOBS}
BANNED = ["BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "zone_name", "elevation_band", "slope_angle", "predicted_danger"]
    assert df.count() > 0


def test_sql_names_are_queries():
    assert set(SQL) <= set(JOBS)


@pytest.mark.parametrize("name", list(JOBS))
def test_equal_to_sql_and_native(spark, con, name):
    plans = []

    def job(spark, sf):
        df = JOBS[name](spark, sf)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    ok, message, _ = compare(spark, con, SF, job, SQL.get(name))
    assert ok, message
    assert not [b for b in BANNED if b in plans[0]]


def test_every_query_has_sql():
    assert set(JOBS) == set(SQL)
