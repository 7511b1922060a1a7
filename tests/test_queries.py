"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from oracle import connect, difference
from smeltery.catalog import QUERIES

RUN = {name: q.run for name, q in QUERIES.items()}
SQL = {name: q.sql for name, q in QUERIES.items() if q.sql is not None}
# Plans that pair rows without a key, or leave the JVM.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "MapInArrow", "Python")
# Unpacks bodies, which the engine has no function for.
OUTSIDE = {"single_pages"}


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(SQL) == set(RUN)


@pytest.mark.parametrize("name", sorted(RUN))
def test_query_matches_sql(spark, con, name):
    frame = RUN[name](spark, SMALL)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert name in OUTSIDE or not [word for word in FORBIDDEN if word in plan]
    assert difference(frame, con, SQL[name]) == ""


def test_every_query_is_registered():
    assert set(RUN) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
