"""Lead time, post-signup events and retention: hand-made cases and brute force on random tables."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest

from eventmart.operators import cart_lead_time, post_signup_events, signup_retention
from eventmart.schemas import ZERO_ID
from tests.tables import at, day, events, rows_of, user_mart

CART, BUY = "TPD003", "TPD004"


def lead_row(spark, rows, **params) -> dict:
    result = cart_lead_time(events(spark, rows), **params).collect()
    assert len(result) == 1
    return result[0].asDict()


@pytest.mark.parametrize(
    ("cart", "buy", "within"),
    [
        ("2021-06-01 00:00:00", "2021-06-01 00:59:00", (1, 1, 1, 1)),
        ("2021-06-01 00:00:00", "2021-06-01 01:00:00", (1, 1, 1, 1)),
        ("2021-06-01 00:00:00", "2021-06-01 01:00:01", (0, 1, 1, 1)),
        ("2021-06-01 00:00:00", "2021-06-02 12:00:00", (0, 0, 0, 1)),
        ("2021-06-01 00:00:00", "2021-06-03 01:00:00", (0, 0, 0, 0)),
        ("2021-06-02 00:00:00", "2021-06-01 00:00:00", (1, 1, 1, 1)),
        ("2021-06-01 00:00:00", None, (0, 0, 0, 0)),
        (None, "2021-06-01 00:00:00", (0, 0, 0, 0)),
    ],
)
def test_lead_time_steps(spark, ansi, cart, buy, within):
    rows = [{"when": cart, "trackingEventCode": CART}] if cart else []
    rows += [{"when": buy, "trackingEventCode": BUY}] if buy else []
    row = lead_row(spark, rows)
    assert row["add_cart_date"] == (at(cart).date() if cart else None)
    assert tuple(row[f"purchase_{h}_hour"] for h in (1, 6, 24, 48)) == within
    assert row["not_purchase"] == (buy is None)
    assert row["not_add_cart_purchase"] == (cart is None)
    assert row["add_cart"] == 1


def test_lead_time_rates_and_filters(spark, ansi):
    row = lead_row(spark, [
        {"when": "2021-06-01 00:00:00", "trackingEventCode": CART, "contentId": c} for c in "abc"
    ] + [
        {"when": "2021-06-01 00:10:00", "trackingEventCode": BUY, "contentId": "a"},
        {"when": "2021-06-01 00:10:00", "trackingEventCode": CART, "osTypeCode": "ATC999"},
        {"when": "2021-06-01 00:10:00", "trackingEventCode": CART, "osTypeCode": None},
        {"when": "2021-09-01 00:10:00", "trackingEventCode": BUY, "contentId": "b"},
    ], start="2021-06-01", end="2021-08-01")
    assert (row["add_cart"], row["purchase_1_hour"], row["purchase_1_hour_rate"]) == (3, 1, 0.33)
    assert (row["not_purchase"], row["not_purchase_rate"]) == (2, 0.67)


def test_purchase_code_depends_on_the_application(spark, ansi):
    rows = [
        {"when": "2021-06-01 00:00:00", "trackingEventCode": CART, "trackingId": app, "contentId": code}
        for app in ("plain", "special") for code in ("TPD004", "TPD011")
    ] + [
        {"when": "2021-06-01 00:00:01", "trackingEventCode": code, "trackingId": app, "contentId": code}
        for app in ("plain", "special") for code in ("TPD004", "TPD011")
    ]
    report = cart_lead_time(events(spark, rows), purchase_code_by_app={"special": "TPD011"})
    assert rows_of(report, "app_name", "add_cart", "purchase_1_hour") == [("plain", 2, 1), ("special", 2, 1)]


def test_post_signup_events_keep_multiplicity(spark, ansi):
    sign = {"event_typecode": "TPD012"}
    frame = user_mart(spark, [
        {"event_date": "2021-01-01"},
        {"event_date": "2021-01-02", "event_hour": "01"} | sign,
        {"event_date": "2021-01-02", "event_hour": "02"} | sign,
        {"event_date": "2021-01-04"},
        {"event_date": "2021-01-04", "app_name": "other"},
        {"event_date": "2021-01-02", "c_id": ZERO_ID} | sign,
        {"event_date": "2021-05-02"} | sign,
    ])
    d2, d4 = day("2021-01-02"), day("2021-01-04")
    assert rows_of(post_signup_events(frame, "2021-01-01", "2021-03-01")) == sorted(
        [("app", "u1", d2, "TPD012", d2)] * 4 + [("app", "u1", d2, "TPD002", d4)] * 2
    )


def test_retention_tells_absent_from_unobservable(spark, ansi):
    frame = user_mart(spark, [
        {"event_typecode": "TPD012"},
        {"event_date": "2021-01-02"},
        {"event_date": "2021-01-02", "event_hour": "05"},
        {"event_date": "2021-01-04"},
    ])
    assert rows_of(signup_retention(frame), "index_name", "repeat_rate") == [
        ("01 day repeat", 100.0), ("02 day repeat", 0.0), ("03 day repeat", 100.0),
        ("04 day repeat", None), ("05 day repeat", None), ("06 day repeat", None),
        ("07 day repeat", None),
    ]


def test_two_signups_of_one_user(spark, ansi):
    frame = user_mart(spark, [
        {"event_typecode": "TPD012", "event_date": "2021-01-01"},
        {"event_typecode": "TPD012", "event_date": "2021-01-03"},
    ])
    assert rows_of(signup_retention(frame, days=2), "register_date", "repeat_rate") == [
        (day("2021-01-01"), 0.0), (day("2021-01-01"), 100.0),
        (day("2021-01-03"), None), (day("2021-01-03"), None),
    ]


def random_mart(seed: int) -> list[dict]:
    rng = random.Random(seed)
    return [
        {
            "app_name": rng.choice("AB"),
            "c_id": rng.choice(["u1", "u2", "u3", "u4", ZERO_ID]),
            "event_typecode": rng.choice(["TPD002", "TPD004", "TPD012"]),
            "event_date": str(dt.date(2021, 1, 1) + dt.timedelta(days=rng.randrange(25))),
            "event_hour": f"{rng.randrange(24):02d}",
        }
        for _ in range(120)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_retention_against_brute_force(spark, seed):
    rows = random_mart(seed)
    start, end = dt.date(2021, 1, 3), dt.date(2021, 1, 22)
    seen = [(r["app_name"], r["c_id"], day(r["event_date"]), r["event_typecode"]) for r in rows]
    seen = [r for r in seen if r[1] != ZERO_ID and start <= r[2] <= end]
    days = defaultdict(set)
    for app, user, date, _ in seen:
        days[app, user].add(date)
    flags = defaultdict(list)
    for app, user, date in {r[:3] for r in seen if r[3] == "TPD012"}:
        for k in range(1, 8):
            index = date + dt.timedelta(days=k)
            observed = index <= max(days[app, user])
            flags[app, date, k].append(100.0 * (index in days[app, user]) if observed else None)
    expected = []
    for (app, date, k), values in flags.items():
        known = [v for v in values if v is not None]
        rate = round(sum(known) / len(known), 2) if known else None
        expected.append((app, date, f"{k:02d} day repeat", rate))
    result = signup_retention(user_mart(spark, rows), start, end)
    assert rows_of(result) == sorted(expected, key=lambda r: [(v is not None, v) for v in r])


@pytest.mark.parametrize("seed", range(3))
def test_post_signup_events_against_brute_force(spark, seed):
    rows = random_mart(seed)
    expected = [
        (s["app_name"], s["c_id"], day(s["event_date"]), t["event_typecode"], day(t["event_date"]))
        for s in rows if s["event_typecode"] == "TPD012" and s["c_id"] != ZERO_ID
        for t in rows
        if (t["app_name"], t["c_id"]) == (s["app_name"], s["c_id"]) and t["event_date"] >= s["event_date"]
    ]
    assert rows_of(post_signup_events(user_mart(spark, rows))) == sorted(expected)
