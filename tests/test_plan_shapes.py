"""Plan-shape guards: operators meant to survive a hot key must not regress to a
window over the key (one task per key) or to pair enumeration."""

import pytest

import __spark_entry__ as E
from conftest import SF001


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["latest_channel_report", "latest_call_rows", "leave_one_out",
                                  "prefix_per_group", "pair_sum", "house_sales", "city_metrics_dy"])
def test_no_window_per_key(spark, name):
    plan = _optimized(E.queries()[name](spark, SF001))
    assert "Window" not in plan, plan


def test_pair_sum_is_equi_joins_only(spark):
    df = E.queries()["pair_sum"](spark, SF001)
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in physical and "NestedLoop" not in physical


def test_channel_maxima_in_one_aggregation(spark):
    plan = _optimized(E.queries()["latest_channel_report"](spark, SF001))
    # the three branch maxima are computed by a single Aggregate over the activities
    assert plan.count("max(CASE WHEN") == 3
    assert plan.count("Aggregate [con_id") == 1


def test_point_filter_reaches_both_panel_scans(spark):
    df = E.queries()["panel_join_point"](spark, SF001)
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert physical.count("EqualTo(user_id,7)") == 2
