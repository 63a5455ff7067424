"""Plan guards: no cartesian or nested-loop joins, filters reach the scan."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", ["drift_kl", "drift_mutual_info", "slice_rows",
                                  "sample_complement", "baseline_trailing", "pmf_overlay",
                                  "random_batches", "describe_numeric"])
def test_no_pairwise_join(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(b in plan for b in BAD), plan


def test_month_filter_pushed_to_scan(spark):
    df = entry.queries()["filter_month"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
