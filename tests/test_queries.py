"""Every registered query against its SQL in another engine, over the whole small tables."""

import pytest

import __spark_entry__ as driver
from starloom.catalogue import QUERIES
from compare import assert_same, connect
from conftest import SMALL
from fixtures import plan

# Joins that pair all rows, and Python functions in a plan.
UNSCALABLE = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas", "InArrow")


@pytest.fixture(scope="module")
def tables():
    con = connect(SMALL)
    yield con
    con.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(driver.queries())
    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, name):
    found = driver.queries()[name](spark, SMALL)
    assert not [step for step in UNSCALABLE if step in plan(found)]
    assert assert_same(found, tables, driver.oracle_sql()[name]) > 0


def test_entry_is_the_star_rollup(spark, tables):
    assert assert_same(driver.entry(spark), tables, driver.oracle_sql()["star_rollup"]) == 42


def test_report_order(spark):
    found = [tuple(r) for r in driver.queries()["units_by_year_branch"](spark, SMALL).collect()]
    assert found == sorted(found, key=lambda r: (r[0], -r[2], r[1]))
