"""Reports straight from the stored tables, in the order they are read in.

An operator leaves its rows unordered, so that whoever aggregates or stores them does not pay for a
sort; ``report`` adds the order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import operators as ops
from eventmart.functions.ranges import Day
from eventmart.plans.jobs import Lake
from eventmart.schemas import EVENT_BY_USER, PURCHASE_BY_USER, TIER1_STORED, stored
from eventmart.sources import read_tier


@dataclass(frozen=True)
class Report:
    """What a report reads, how it is computed and how it is ordered."""

    table: str
    operator: Callable[..., DataFrame]
    order: tuple[str, ...] = ()

    def order_columns(self) -> list[Column]:
        return [
            F.col(name.removesuffix(" desc")).desc() if name.endswith(" desc") else F.col(name)
            for name in self.order
        ]


_SHAPES = {
    "events": TIER1_STORED,
    "event_by_user": stored(EVENT_BY_USER),
    "purchase_by_user": stored(PURCHASE_BY_USER),
}

_LINE = ("app_name", "os_typecode")

REPORTS = {
    "sales_by_event_time": Report(
        "events", ops.sales_by_event_time, ("trackingId", "osTypeCode", "eventTimeStamp")
    ),
    "daily_sales": Report("purchase_by_user", ops.daily_sales, (*_LINE, "event_date")),
    "moving_avg": Report("purchase_by_user", ops.moving_avg, (*_LINE, "event_date")),
    "running_total": Report("purchase_by_user", ops.running_total, (*_LINE, "event_date")),
    "month_over_month": Report(
        "purchase_by_user", ops.month_over_month, (*_LINE, "event_year", "event_month")
    ),
    "price_histogram": Report("events", ops.price_histogram, ("bucket",)),
    "event_slice": Report("events", ops.event_slice),
    "distinct_users": Report("event_by_user", ops.distinct_users),
    "active_days": Report(
        "event_by_user", ops.active_days, ("app_name", "event_day_count desc")
    ),
    "hourly_funnel": Report(
        "event_by_user", ops.hourly_funnel, ("event_date desc", "event_hour", *_LINE)
    ),
    "event_venn": Report(
        "event_by_user",
        ops.event_venn,
        (*_LINE, "has_purchased", "has_cart", "has_viewcontent"),
    ),
    "weekday_by_hour": Report("event_by_user", ops.weekday_by_hour, ("app_name", "event_hour")),
    "slice_count": Report("event_by_user", ops.slice_count),
    "cart_lead_time": Report("events", ops.cart_lead_time, (*_LINE, "add_cart_date")),
    "post_signup_events": Report(
        "event_by_user", ops.post_signup_events, ("app_name", "c_id", "event_date")
    ),
    "signup_retention": Report(
        "event_by_user", ops.signup_retention, ("app_name", "register_date", "index_name")
    ),
}


def report(
    spark: SparkSession, lake: Lake, name: str, start: Day = None, end: Day = None, **params
) -> DataFrame:
    """A report over the stored tables; the date range prunes partitions of its table."""
    spec = REPORTS[name]
    table = read_tier(spark, getattr(lake, spec.table), start, end, _SHAPES[spec.table])
    result = spec.operator(table.drop("date", "hour", "run_date"), **params)
    return result.orderBy(*spec.order_columns()) if spec.order else result
