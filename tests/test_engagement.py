"""Engagement reports on small tables, and what they have to agree on."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventmart.operators import (
    active_days,
    distinct_users,
    event_venn,
    hourly_funnel,
    slice_count,
    weekday_by_hour,
)
from eventmart.plans.adapters import standard_events
from eventmart.operators import event_by_user
from tests.tables import day, rows_of, user_mart

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def mart(spark):
    return event_by_user(standard_events(spark, SF_DIR)).cache()


def test_distinct_users(spark, ansi):
    frame = user_mart(spark, [{}, {"event_hour": "01"}, {"app_name": "b"}, {"event_date": "2022-01-01"}])
    assert rows_of(distinct_users(frame, "2021-01-01", "2021-02-01")) == [("app", "u1"), ("b", "u1")]


def test_active_days_shares(spark, ansi):
    frame = user_mart(spark, [
        {"c_id": "a"}, {"c_id": "b"}, {"c_id": "b", "event_hour": "01"},
        {"c_id": "c"}, {"c_id": "c", "event_date": "2021-01-05"},
    ])
    assert rows_of(active_days(frame)) == [
        ("app", 1, 2, 200 / 3, 200 / 3), ("app", 2, 1, 100 / 3, 100.0),
    ]


def test_active_days_end_at_hundred(mart):
    last = active_days(mart).groupBy("app_name").agg(
        F.max_by("cumulative_ratio", "event_day_count").alias("last"), F.sum("user_count").alias("n")
    )
    users = {r.app_name: r.n for r in distinct_users(mart).groupBy("app_name").agg(F.count("*").alias("n")).collect()}
    for row in last.collect():
        assert row["last"] == 100.0
        assert row.n == users[row.app_name]


def test_hourly_funnel(spark, ansi):
    codes = ["TPD008", "TPD009", "TPD007", "TPD001", "TPD002", "TPD003", "TPD016", "TPD004", "TPD004"]
    frame = user_mart(spark, [
        {"event_typecode": code, "c_id": f"u{i % 2}"} for i, code in enumerate(codes)
    ])
    row = hourly_funnel(frame).collect()[0].asDict()
    assert row == {
        "event_date": day("2021-01-01"), "event_hour": "00", "app_name": "app", "os_typecode": "ATC001",
        "user_count": 2, "user_access_count": 9, "install": 1, "open": 1, "search": 2,
        "viewcontent": 1, "addtocart": 2, "purchase": 2, "search_per_user": 1.0,
        "viewcontent_per_user": 0.5, "addtocart_per_user": 1.0, "purchase_per_user": 1.0,
    }


def test_venn(spark, ansi):
    frame = user_mart(spark, [
        {"c_id": "a", "event_typecode": "TPD002"},
        {"c_id": "a", "event_typecode": "TPD004"},
        {"c_id": "b", "event_typecode": "TPD011"},
        {"c_id": "c", "event_typecode": "TPD009"},
        {"c_id": "d", "event_typecode": "TPD002", "app_name": None},
        {"c_id": "d", "event_typecode": "TPD002", "os_typecode": None},
    ])
    report = {r[2:5]: r[5:] for r in rows_of(event_venn(frame))}
    assert report["any", "any", "any"] == (2, 100.0)
    assert report["not viewcontent", "not cart", "not purchase"] == (1, 50.0)
    assert report["viewcontent", "not cart", "purchase"] == (1, 50.0)
    assert report["any", "not cart", "any"] == (2, 100.0)
    assert ("any", "cart", "any") not in report
    # Each of the two flag combinations is in 8 cells; they share those that keep only "not cart".
    assert len(report) == 8 + 8 - 2


def test_venn_total_is_the_number_of_users(mart):
    codes = ("TPD002", "TPD003", "TPD004", "TPD011")
    users = mart.where(F.col("event_typecode").isin(*codes)).groupBy("app_name", "os_typecode").agg(
        F.count_distinct("c_id").alias("n")
    )
    total = event_venn(mart).where(
        "has_viewcontent = 'any' AND has_cart = 'any' AND has_purchased = 'any'"
    )
    assert rows_of(users) == rows_of(total, "app_name", "os_typecode", "user_count")
    assert rows_of(total.select("ratio").distinct()) == [(100.0,)]


def test_weekdays_without_rows_are_null(spark, ansi):
    frame = user_mart(spark, [{}, {"c_id": "b"}, {"event_date": "2021-01-03"}])  # Friday and Sunday
    assert rows_of(weekday_by_hour(frame)) == [("app", "00", None, None, None, None, 2, None, 1)]


def test_slice_count_is_one_cell_of_the_weekday_table(mart):
    cells = weekday_by_hour(mart).where("event_hour = '07'").collect()
    assert cells
    for row in cells:
        for weekday in ("Mon", "Wed", "Sun"):
            count = slice_count(mart, row.app_name, "07", weekday).collect()[0].row_count
            assert count == (row[weekday.lower()] or 0)
