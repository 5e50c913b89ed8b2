"""Per-user marts."""

from __future__ import annotations

import pytest

from eventmart.functions import second_diff
from eventmart.operators import (
    event_by_user,
    event_by_user_daily,
    purchase_by_user,
    purchase_by_user_from_ts,
)
from eventmart.plans.adapters import with_instants
from eventmart.schemas import EVENT_BY_USER, PURCHASE_BY_USER
from pyspark.sql import functions as F
from tests.tables import at, day, events, rows_of


def test_unusable_applications_and_users_are_left_out(spark, ansi):
    frame = events(spark, [
        {"trackingId": app, "cid": user}
        for app in (None, "", "  ", "HNS_DEV", "app")
        for user in (None, "", "u1")
    ])
    assert rows_of(event_by_user(frame), "app_name", "c_id", "event_count") == [("app", "u1", 1)]
    kept = event_by_user(frame, exclude_apps=())
    assert rows_of(kept, "app_name") == [("HNS_DEV",), ("app",)]


def test_event_counts(spark, ansi):
    frame = events(spark, [
        {"when": "2021-01-01 05:00:00"},
        {"when": "2021-01-01 05:59:59"},
        {"when": "2021-01-01 06:00:00"},
        {"when": "2021-01-02 05:00:00", "trackingEventCode": "TPD002"},
        {"when": "2021-01-03 05:00:00"},
    ])
    mart = event_by_user(frame, "2021-01-01", "2021-01-02")
    assert [(f.name, f.dataType) for f in mart.schema] == [(f.name, f.dataType) for f in EVENT_BY_USER]
    assert rows_of(mart, "event_date", "event_hour", "event_typecode", "event_count") == [
        (day("2021-01-01"), "05", "TPD004", 2),
        (day("2021-01-01"), "06", "TPD004", 1),
        (day("2021-01-02"), "05", "TPD002", 1),
    ]
    daily = event_by_user_daily(frame)
    assert "event_hour" not in daily.columns
    assert rows_of(daily, "event_year", "event_month", "event_day", "event_count") == [
        (2021, 1, 1, 3), (2021, 1, 2, 1), (2021, 1, 3, 1),
    ]


def test_what_counts_as_purchase(spark, ansi):
    frame = events(spark, [
        {"amount": 5, "quantity": 2},
        {"amount": 7, "quantity": None},
        {"amount": 0},
        {"amount": -3},
        {"amount": None},
        *({"trackingEventCode": code, "amount": 100} for code in ("TPD010", "TPD011", "TPD015")),
        {"cid": None, "contentId": None, "amount": 2},
    ])
    mart = purchase_by_user(frame)
    assert mart.schema.names == PURCHASE_BY_USER.names
    assert [f.dataType for f in mart.schema] == [f.dataType for f in PURCHASE_BY_USER]
    assert rows_of(mart, "c_id", "content_id", "quantity_total", "amount_total") == [
        (None, None, 1, 2), ("u1", "p1", 2, 12),
    ]
    wider = purchase_by_user(frame, codes=("TPD004", "TPD011"))
    assert rows_of(wider.where("c_id = 'u1'"), "amount_total") == [(112,)]


def test_purchase_date_from_timestamp(spark, ansi):
    frame = events(spark, [
        {"when": "2021-01-01 20:00:00", "amount": 5},
        {"when": "2021-01-02 10:00:00", "amount": 7, "eventDate": day("2020-01-01")},
    ])
    ours = purchase_by_user_from_ts(frame)
    assert rows_of(ours, "event_date", "amount_total") == [
        (day("2021-01-01"), 5), (day("2021-01-02"), 7),
    ]
    in_seoul = purchase_by_user_from_ts(with_instants(frame), tz="Asia/Seoul")
    assert rows_of(in_seoul, "event_date", "event_day", "amount_total") == [(day("2021-01-02"), 2, 12)]
    assert purchase_by_user_from_ts(frame, "2021-01-02", "2021-01-02").count() == 1


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_seconds_are_cut_before_they_are_compared(spark, kind):
    pair = spark.createDataFrame(
        [(at("2021-01-01 00:00:00.900000"), at("2021-01-01 00:00:01.100000"))], f"a {kind}, b {kind}"
    )
    assert pair.select(second_diff(F.col("b"), F.col("a"))).collect()[0][0] == 1
