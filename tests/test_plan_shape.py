"""Every registered query plans without a Cartesian product or nested-loop join, and reads
only the columns it needs from the flights' largest input."""
import importlib

import pytest

from conftest import SF_SMALL

from ontime_spark import registry

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_cartesian_or_nested_loop(spark, name):
    E = importlib.import_module("__spark_entry__")
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name} plans a {bad}"


def test_flights_scan_is_pruned(spark):
    from ontime_spark.sources import driver
    plan = _plan(driver.flights(spark, SF_SMALL))
    assert "l_extendedprice" not in plan and "l_linestatus" not in plan
    assert "o_totalprice" not in plan and "c_acctbal" not in plan
