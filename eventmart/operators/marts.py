"""Daily per-user marts from the event table.

Each is one hash aggregation. Partial sums are built before the shuffle, so a user, application or
day that holds a large share of all events arrives as at most one row per scan task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from eventmart.functions import between_dates, local_date
from eventmart.functions.ranges import Day, as_date
from eventmart.schemas import EVENT_BY_USER, EXCLUDED_APPS, PURCHASE, PURCHASE_BY_USER


def _with_date_parts(mart: DataFrame) -> DataFrame:
    return mart.withColumns({
        "event_year": F.year("event_date"),
        "event_month": F.month("event_date"),
        "event_day": F.dayofmonth("event_date"),
    })


def _known_user(exclude_apps: Sequence[str]) -> Column:
    app, user = F.col("trackingId"), F.col("cid")
    known = (F.trim(app) != "") & (user != "")
    return known & ~app.isin(*exclude_apps) if exclude_apps else known


def _count_events(
    events: DataFrame, hourly: bool, start: Day, end: Day, exclude_apps: Sequence[str]
) -> DataFrame:
    columns = [c for c in EVENT_BY_USER.names if hourly or c != "event_hour"]
    hour = [F.col("eventHour").alias("event_hour")] if hourly else []
    counted = (
        events.where(between_dates("eventDate", start, end) & _known_user(exclude_apps))
        .groupBy(
            F.col("trackingId").alias("app_name"),
            F.col("osTypeCode").alias("os_typecode"),
            F.col("eventDate").alias("event_date"),
            *hour,
            F.col("cid").alias("c_id"),
            F.col("trackingEventCode").alias("event_typecode"),
        )
        .agg(F.count(F.lit(1)).alias("event_count"))
    )
    return _with_date_parts(counted).select(*columns)


def event_by_user(
    events: DataFrame,
    start: Day = None,
    end: Day = None,
    exclude_apps: Sequence[str] = EXCLUDED_APPS,
) -> DataFrame:
    """Events per application, platform, date, hour, user and event code."""
    return _count_events(events, True, start, end, exclude_apps)


def event_by_user_daily(
    events: DataFrame,
    start: Day = None,
    end: Day = None,
    exclude_apps: Sequence[str] = EXCLUDED_APPS,
) -> DataFrame:
    """The same without the hour."""
    return _count_events(events, False, start, end, exclude_apps)


def _sum_purchases(events: DataFrame, codes: Sequence[str]) -> DataFrame:
    summed = (
        events.where((F.col("amount") > 0) & F.col("trackingEventCode").isin(*codes))
        .groupBy(
            F.col("trackingId").alias("app_name"),
            F.col("osTypeCode").alias("os_typecode"),
            F.col("purchase_day").alias("event_date"),
            F.col("cid").alias("c_id"),
            F.col("contentId").alias("content_id"),
        )
        .agg(F.sum("quantity").alias("quantity_total"), F.sum("amount").alias("amount_total"))
    )
    return _with_date_parts(summed).select(*PURCHASE_BY_USER.names)


def purchase_by_user(
    events: DataFrame,
    start: Day = None,
    end: Day = None,
    codes: Sequence[str] = (PURCHASE,),
) -> DataFrame:
    """Quantity and amount per application, platform, date, user and content.

    In-app and first purchases have codes of their own and refunds are not subtracted; pass
    ``codes`` to count others.
    """
    in_range = events.where(between_dates("eventDate", start, end))
    return _sum_purchases(in_range.withColumn("purchase_day", F.col("eventDate")), codes)


def purchase_by_user_from_ts(
    events: DataFrame,
    start: Day = None,
    end: Day = None,
    codes: Sequence[str] = (PURCHASE,),
    tz: str = "UTC",
    prune: bool = False,
) -> DataFrame:
    """The same with the date taken from the event timestamp (local to ``tz``).

    With ``prune`` a range also reaches the scan, by the stored date: for tables, such as those of this
    library, whose stored date is that of the event timestamp in some time zone.
    """
    moment = F.col("eventTimeStamp")
    without_zone = isinstance(events.schema["eventTimeStamp"].dataType, TimestampNTZType)
    purchase_day = F.to_date(moment) if without_zone else local_date(moment, tz)
    # Dates of one instant in two time zones lie within two days of each other.
    first, last = as_date(start), as_date(end)
    stored_range = between_dates(
        "eventDate",
        first and first - dt.timedelta(days=2) if first and first.year > 1 else None,
        last and last + dt.timedelta(days=2) if last and last.year < 9999 else None,
    )
    dated = (events.where(stored_range) if prune else events).withColumn("purchase_day", purchase_day)
    return _sum_purchases(dated.where(between_dates("purchase_day", start, end)), codes)
