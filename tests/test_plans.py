"""Physical-plan checks: no Python in operator plans, broadcast dims, group-limit windows."""

import pytest

from coursewise.plans import registry
from coursewise.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"
STREAMING = {"s10_incremental_load", "g35_alert_feed"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - STREAMING))
def test_no_python_udf(spark, name):
    p = plan(registry.QUERIES[name](spark, SF))
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_dim_course_broadcasts_lookups(spark):
    p = plan(Warehouse(spark, SF).dim_course)
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_best_record_uses_group_limit(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(Warehouse(spark, SF).fct_course_snapshot)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in p


def test_scan_prunes_columns(spark):
    df = registry.QUERIES["g12_overview_kpis"](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "l_comment" not in p and "ReadSchema" in p
