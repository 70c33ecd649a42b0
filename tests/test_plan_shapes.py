"""The plan-shape guarantees of PLANS.md, for every registered key:
no nested-loop or cartesian join, no Python evaluation, column-pruned scans,
and the sensor filters pushed into the event scans."""

import re

import pytest

from vitalis.plans import registry

SF = "/root/testdata/sf0.001"
KEYS = sorted(registry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_plan_shape(spark, key):
    plan = registry.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan)
    assert scans, "every key reads the given tables"
    # these read back the table that they have written, all columns of it
    assert key in ("etl_publish", "a14_maintained") or max((len(s.split(",")) for s in scans), default=0) <= 8
    for line in plan.splitlines():
        cols = re.search(r"FileScan parquet [^\[]*\[([^\]]*)\]", line)
        if cols and "events.parquet" in line and "event_type" in cols.group(1):
            # a sensor derived from the event stream: its type filter reaches the scan
            assert "In(event_type" in line
