"""Operators: functions from DataFrame to DataFrame."""

from eventmart.operators.engagement import (
    active_days,
    distinct_users,
    event_slice,
    event_venn,
    hourly_funnel,
    slice_count,
    weekday_by_hour,
)
from eventmart.operators.lifecycle import cart_lead_time, post_signup_events, signup_retention
from eventmart.operators.marts import (
    event_by_user,
    event_by_user_daily,
    purchase_by_user,
    purchase_by_user_from_ts,
)
from eventmart.operators.sales import (
    daily_sales,
    month_over_month,
    moving_avg,
    price_histogram,
    running_total,
    sales_by_event_time,
)
from eventmart.operators.sequence import with_next_event
from eventmart.operators.standardize import (
    FAULTS,
    empty_events,
    raw_quality,
    standardize,
    union_events,
    with_faults,
    with_partition_columns,
    with_process_time,
)

__all__ = [
    "FAULTS", "active_days", "cart_lead_time", "daily_sales", "distinct_users", "empty_events", "event_by_user",
    "event_by_user_daily", "event_slice", "event_venn", "hourly_funnel", "month_over_month",
    "moving_avg", "post_signup_events", "price_histogram", "purchase_by_user",
    "purchase_by_user_from_ts", "raw_quality", "running_total", "sales_by_event_time",
    "signup_retention", "slice_count", "standardize", "union_events", "weekday_by_hour",
    "with_faults", "with_next_event", "with_partition_columns", "with_process_time",
]
