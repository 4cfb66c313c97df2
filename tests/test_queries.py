"""Every query of the catalog against its SQL on the smallest tables, and plan shapes.

The corpus queries have tests of their own.
"""

import re

import pytest

import __spark_entry__ as entry
from hourgrid.plans import catalog
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
catalog.load_all()
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLES) == {"ridge_forecast", "ridge_daily_orders"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    """Equal to its SQL; no Cartesian product and no window without partitioning in its plan."""
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    for window in re.findall(r"Window \[.*", plan):
        assert not re.search(r"\], \[\](, \[|$)", window), window
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and {"city", "ds", "y", "aqi_lag_24h", "aqi_roll_mean_24h", "hour_sin", "is_rush_hour"} <= set(df.columns)


def test_scan_reads_only_needed_columns(spark):
    plan = QUERIES["ks_drift"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert scans and all("props" not in s and "event_id" not in s for s in scans)
    pushed = QUERIES["latest_per_sensor"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", pushed)
