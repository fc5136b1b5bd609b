"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_point
from oracle import connect, difference

QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


# the operators for training data have tests of their own
OWN = sorted(n for n in QUERIES if n != "pipeline" and not n.startswith("op"))


def test_each_query_has_sql():
    assert set(OWN) <= set(ORACLES)


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, con, sf_dir, name):
    assert difference(spark, con, QUERIES[name], ORACLES[name], sf_dir) == ""


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert rows and entry_point.entry(spark).columns == ["bucket", "cnt"]


# what these return is read from tables that they have written
_EAGER = {
    "json_export", "day_overwrite", "day_drop", "reconcile", "day_versions", "lake_latest_day", "catalog_tables", "load_report",
    "fast_in_out_split", "dashboard_cube",
}


@pytest.mark.parametrize(
    "name", sorted(n for n in OWN if not n.startswith(("stream_", "ods_load_")) and n not in _EAGER)
)
def test_plan_scales(spark, sf_dir, name):
    """No cross or nested-loop join, no window over a whole group, no Python in any plan.

    Windows over an account's rows of one stretch of time are bounded by its length.
    """
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    if name == "fast_in_out":
        assert "RangeFrame" in plan and "stretch" in plan
        plan = plan.replace("Window [", "")
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "WindowExec", "Window [", "Python", "Pandas"):
        assert operator not in plan, operator
