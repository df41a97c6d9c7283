"""Physical-plan checks: no nested-loop or cartesian joins in the heavy paths,
no Python UDF anywhere, pruned scans."""

import pytest

from cohortcast.plans.queries import build, queries
from conftest import SF_SMALL

HEAVY = ["trip_day_facts", "trailing_channel", "trailing_increment", "trailing_total",
         "channel_rates", "final_forecast", "actuals", "weighted_accuracy"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", HEAVY)
def test_no_nested_loop_or_cartesian(spark, key):
    plan = _plan(build(key, spark, SF_SMALL))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_no_python_udf_anywhere(spark):
    for key, fn in queries().items():
        if key in ("csv_roundtrip", "backtest_csv"):
            continue
        plan = _plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key


def test_scans_are_pruned(spark):
    """No orders scan reads every column; filters reach the scan."""
    plan = _plan(build("final_forecast", spark, SF_SMALL))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "o_orderkey" in line]
    assert scans
    for line in scans:
        schema = line[line.index("ReadSchema: struct<"):]
        assert schema.count(":") < 6, line


@pytest.mark.parametrize("key", ["final_forecast", "weighted_accuracy", "channel_rates"])
def test_cube_consumers_read_the_staged_table(spark, key):
    """Every consumer of the cube reads the staged Parquet, and only the columns
    it uses; none re-expands the facts."""
    plan = build(key, spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "paid_days" in plan and "parquet" in plan and "is_ever_booked" not in plan
    assert "explode(sequence(cast((cast(_a" not in plan       # the bucket explode
    assert "explode(sequence(_lo, _hi" not in plan            # the day explode
