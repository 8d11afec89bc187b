"""Every registered query against its oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, differ
from suite.registry import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    return connect(FOLDER)


def check_plan(name, plan):
    """No cross join anywhere; Python only where files or formulas are read and equations are solved."""
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if not name.startswith(("a1_", "a2_", "a6_pivot_caches", "a8_", "a12_", "a17_", "b19_rich_text", "e", "k6_")):
        assert "Python" not in plan and "ArrowEval" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, oracle):
    df = QUERIES[name](spark, FOLDER)
    check_plan(name, df._jdf.queryExecution().executedPlan().toString())
    got = df.toPandas()
    sql = SQL.get(name)
    if sql is None:
        assert len(got)
        return
    problem = differ(got, oracle.execute(sql).df())
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())


def test_every_sheet_spec_is_in_a_query():
    from gridspark.plans.sheet_specs import SPECS

    told = "".join(sql for name, sql in SQL.items() if name.startswith("m34_specs"))
    assert [s for s in SPECS if f"'{s}' AS spec" not in told] == []
