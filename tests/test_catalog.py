"""Every catalog query against its SQL on the smallest tables, and the plans all of them have."""

import re

import pytest

import __spark_entry__ as driver
from compare import connect, differences
from tidemark.plans import catalog, oracle

SF_DIR = driver.SMALL
QUERIES, ORACLE = catalog.queries(), oracle.oracle_sql()

NEVER = re.compile(
    r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|BatchEvalPython|ArrowEvalPython"
    r"|MapInPandas|SinglePartition"
)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= driver.queries().keys() and ORACLE.keys() <= driver.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, con, plan, name):
    df = QUERIES[name](spark, SF_DIR)
    found = NEVER.findall(plan(df))
    # One row of counters, whatever the size of the input.
    allowed = ["SinglePartition"] if re.fullmatch(r"dq_.*counts.*", name) else []
    assert set(found) <= set(allowed), found
    assert differences(df, con, ORACLE[name]) == []


def test_flagship(spark):
    df = driver.entry(spark)
    assert {"event_count", "unique_entities", "window_start"} <= set(df.columns)
    assert df.count() > 0
