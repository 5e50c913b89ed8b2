"""What the optimiser makes of the operators."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from eventmart import operators as ops
from eventmart.plans.adapters import purchase_mart, standard_events, with_instants
from eventmart.schemas import EVENT_BY_USER, TIER1_STORED, stored
from eventmart.sources import read_tier, write_tier1, write_tier2

SF_DIR = "/root/testdata/sf0.001"


def plan(frame) -> str:
    """Physical plan without its adaptive final form."""
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    instants = with_instants(standard_events(spark, SF_DIR))
    write_tier1(instants, f"{root}/event", "2024-01-30")
    write_tier2(ops.event_by_user(instants), f"{root}/users")
    return root


def test_date_range_prunes_partitions_and_columns(spark, lake):
    events = read_tier(spark, f"{lake}/event", "2024-01-05", "2024-01-06", TIER1_STORED)
    text = plan(ops.event_by_user(events))
    filters = re.search(r"PartitionFilters: \[(.*?)\], Pushed", text).group(1)
    assert "date" in filters
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {
        "trackingId", "trackingEventCode", "cid", "osTypeCode", "eventDate", "eventHour",
    }
    assert len(events.inputFiles()) > 2


def test_filters_reach_the_scan(spark, lake):
    events = read_tier(spark, f"{lake}/event", schema=TIER1_STORED)
    text = plan(ops.purchase_by_user(events, "2024-01-05", "2024-01-06"))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for expected in ("GreaterThan(amount,0)", "EqualTo(trackingEventCode,TPD004)", "GreaterThanOrEqual(eventDate"):
        assert expected in pushed


def operators(spark, lake):
    events = read_tier(spark, f"{lake}/event", schema=TIER1_STORED)
    users = read_tier(spark, f"{lake}/users", schema=stored(EVENT_BY_USER))
    purchases = purchase_mart(spark, SF_DIR)
    # Number of shuffles each operator needs on tables as stored.
    return {
        "event_by_user": (ops.event_by_user(events), 1),
        "event_by_user_daily": (ops.event_by_user_daily(events), 1),
        "purchase_by_user": (ops.purchase_by_user(events), 1),
        "purchase_by_user_from_ts": (ops.purchase_by_user_from_ts(events), 1),
        "sales_by_event_time": (ops.sales_by_event_time(events), 1),
        "price_histogram": (ops.price_histogram(events), 1),
        "event_slice": (ops.event_slice(events, F.col("value") == 2), 0),
        "cart_lead_time": (ops.cart_lead_time(events), 2),
        "distinct_users": (ops.distinct_users(users), 1),
        "active_days": (ops.active_days(users), 4),
        "hourly_funnel": (ops.hourly_funnel(users), 2),
        "event_venn": (ops.event_venn(users), 4),
        "weekday_by_hour": (ops.weekday_by_hour(users), 1),
        "slice_count": (ops.slice_count(users, "app_1", "00", "Mon"), 1),
        "post_signup_events": (ops.post_signup_events(users), None),
        "signup_retention": (ops.signup_retention(users), None),
        "next_event": (ops.with_next_event(events), None),  # see below
        "daily_sales": (ops.daily_sales(purchases), None),
        "moving_avg": (ops.moving_avg(purchases), None),
        "running_total": (ops.running_total(purchases), None),
        "month_over_month": (ops.month_over_month(purchases), None),
    }


def test_no_python_rows_no_pairs_of_everything(spark, lake):
    for name, (frame, _) in operators(spark, lake).items():
        text = plan(frame)
        for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition, ENSURE"):
            if unwanted.startswith("Single") and name in ("slice_count", "event_slice"):
                continue  # one partial count per task, or one row per task
            assert unwanted not in text, f"{unwanted} in {name}"


def test_number_of_shuffles(spark, lake):
    counted = {
        name: (len(re.findall(r"Exchange (?:hash|Single|range|RoundRobin)", plan(frame))), expected)
        for name, (frame, expected) in operators(spark, lake).items()
        if expected is not None
    }
    assert {n: c for n, (c, _) in counted.items()} == {n: e for n, (_, e) in counted.items()}


def test_shuffles_that_next_event_runs(spark):
    """Events by second, seconds by user and hour, hours by user, and events to their second; what is needed twice is reused."""
    found = ops.with_next_event(standard_events(spark, SF_DIR))
    found.collect()
    lines = plan(found).split("== Initial Plan ==")[0].splitlines()
    assert sum("Exchange hash" in line and "Reused" not in line for line in lines) == 4


def test_windows_see_aggregated_rows_only(spark, lake):
    """Below every window there is an aggregation, so no user's or application's raw rows meet in one task."""
    for name, (frame, _) in operators(spark, lake).items():
        lines = plan(frame).splitlines()
        for number, line in enumerate(lines):
            if re.search(r"\bWindow \[", line):
                assert any("Aggregate(" in below for below in lines[number:]), name
