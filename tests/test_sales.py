"""Sales reports on small tables."""

from __future__ import annotations

import pytest

from eventmart.operators import (
    daily_sales,
    event_slice,
    month_over_month,
    moving_avg,
    price_histogram,
    running_total,
    sales_by_event_time,
)
from pyspark.sql import functions as F
from tests.tables import at, day, events, purchase_mart, rows_of


def test_sales_by_event_time(spark, ansi):
    frame = events(spark, [
        {"when": "2021-01-01 00:00:00", "value": 10, "amount": 20},
        {"when": "2021-01-01 00:00:00", "value": 5, "amount": None},
        {"when": "2021-01-03 00:00:00"},
        {"when": "2020-12-31 23:59:59"},
    ])
    report = sales_by_event_time(frame, "2021-01-01", "2021-01-02")
    assert rows_of(report) == [("app", "ATC001", at("2021-01-01 00:00:00"), 1, 15, 20, 20.0)]


def test_daily_sales_counts_mart_rows(spark, ansi):
    mart = purchase_mart(spark, [
        {"amount_total": 1, "quantity_total": 9},
        {"amount_total": 1, "content_id": "p2"},
        {"amount_total": 2, "c_id": "u2"},
        {"amount_total": 5, "event_date": "2021-01-02"},
    ])
    assert rows_of(daily_sales(mart, "2021-01-01", "2021-01-01")) == [
        ("app", "ATC001", day("2021-01-01"), 3, 4, 1.33)
    ]


def daily(spark, days, **extra):
    return purchase_mart(spark, [
        {"event_date": f"2021-01-{d:02d}", "amount_total": d} | extra for d in days
    ])


def test_moving_average_needs_seven_days_and_ignores_gaps(spark, ansi):
    assert rows_of(moving_avg(daily(spark, range(1, 7))), "amount_avg_7day") == [(None,)] * 6
    rows = rows_of(
        moving_avg(daily(spark, [1, 2, 3, 4, 5, 6, 20, 21])), "event_date", "amount_avg_7day", "avg"
    )
    assert rows[5] == (day("2021-01-06"), None, None)
    assert rows[6] == (day("2021-01-20"), 41 / 7, 5)
    assert rows[7] == (day("2021-01-21"), 61 / 7, 8)
    assert moving_avg(daily(spark, [1]), n=3).columns[-2] == "amount_avg_3day"


def test_running_total_ends_at_the_sum(spark, ansi):
    mart = daily(spark, [1, 2, 5]).unionByName(daily(spark, [2, 9], os_typecode="ATC002"))
    rows = rows_of(running_total(mart), "os_typecode", "event_date", "amount_total", "amount_agg")
    assert [r[3] for r in rows] == [1, 3, 8, 2, 11]
    assert running_total(mart, "2021-01-02", "2021-01-05").count() == 3


def test_month_over_month_compares_with_the_last_month_that_sold(spark, ansi):
    mart = purchase_mart(spark, [
        {"event_date": "2020-12-05", "amount_total": 4},
        {"event_date": "2021-01-05", "amount_total": 10},
        {"event_date": "2021-03-05", "amount_total": 25},
        {"event_date": "2021-03-06", "amount_total": 1},
        {"event_date": "2021-03-06", "amount_total": 1, "app_name": ""},
    ])
    columns = ("event_year", "event_month", "amount_total", "pre_amount", "diff_amount")
    assert rows_of(month_over_month(mart), *columns) == [
        (2020, 12, 4, None, None), (2021, 1, 10, 4, 6), (2021, 3, 26, 10, 16),
    ]
    assert rows_of(month_over_month(mart, 2021), *columns)[0] == (2021, 1, 10, None, None)


def test_price_histogram_edges(spark, ansi):
    prices = [100, 101, 999_999, 1_000_000, 10_000_000, 10_000_001, None]
    frame = events(spark, [{"value": p} for p in prices] + [{"value": 500, "trackingEventCode": "TPD011"}])
    assert rows_of(price_histogram(frame)) == [
        (1, 0.0, 1_000_000.0, 2, 1_000_100),
        (2, 1_000_000.0, 2_000_000.0, 1, 1_000_000),
        (11, 10_000_000.0, 11_000_000.0, 1, 10_000_000),
    ]


def test_histogram_counts_every_filtered_row(spark):
    frame = events(spark, [{"value": v} for v in range(0, 1200, 7)])
    report = price_histogram(frame, lo=0, hi=1000, buckets=8, min_price=100)
    counted = report.agg(F.sum("num_purchase")).collect()[0][0]
    assert counted == sum(100 < v <= 1000 for v in range(0, 1200, 7))
    for bucket, lower, upper, _, _ in report.collect():
        assert (lower, upper) == (125.0 * (bucket - 1), 125.0 * bucket)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_event_slice_is_the_first_rows(spark, n):
    frame = events(spark, [{"value": 2, "cid": c} for c in "dbca"] + [{"value": 3, "cid": "A"}])
    rows = event_slice(frame, F.col("value") == 2, n)
    assert rows_of(rows, "cid") == [(c,) for c in "abcd"[:n]]
    assert rows.columns == frame.columns
