"""Plan guards: what must hold at 100 TB, checked on the physical plans."""

import pytest

from conftest import SF_SMALL
from martlane import catalog
from martlane.operators import alerts, dau
from martlane.sources import fixtures as fx

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")
BATCH = sorted(set(catalog.QUERIES) - set(catalog.STREAM_QUERIES))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_or_python(spark, name):
    p = plan(catalog.QUERIES[name](spark, SF_SMALL))
    assert not [f for f in FORBIDDEN if f in p], p


def test_day_range_reaches_the_scan(spark):
    p = plan(fx.startup_logs(spark, SF_SMALL, "2024-01-15", "2024-01-15"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p
    assert "LessThan(ts," in p


def test_projection_prunes_columns(spark):
    p = plan(dau.dau_first_visits(fx.startup_logs(spark, SF_SMALL)))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in p


def test_pick_per_key_aggregates_before_the_shuffle(spark):
    p = plan(dau.dau_first_visits(fx.startup_logs(spark, SF_SMALL)))
    assert "partial_min" in p and "Exchange hashpartitioning(mid" in p


def test_alert_panes_aggregate_before_fan_out(spark):
    p = plan(alerts.coupon_alerts(fx.event_logs(spark, SF_SMALL), 7200, 1800, 3))
    # raw events meet a partial aggregate first; the explode (fan-out) sits above it
    assert p.index("Generate explode") < p.rindex("partial_count")
