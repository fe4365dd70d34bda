"""Every registered query against its SQL, and what its plan may not contain."""

import pytest

import __spark_entry__ as entry
from catalog.queries import QUERIES as CATALOG
from checks.compare import connect, difference, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in CATALOG}
QUERIES = {name: query for name, query in entry.queries().items() if name in CATALOG}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
    assert difference(spark_rows(df), sql_rows(duck, ORACLE[name])) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["topic", "post_count", "avg_score", "avg_comments"]
