"""User engagement reports over the per-user event mart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions import between_dates, ratio
from eventmart.functions.ranges import Day
from eventmart.schemas import (
    CART,
    CART_ALT,
    IN_APP_PURCHASE,
    INSTALL,
    OPEN,
    PURCHASE,
    SEARCH,
    SEARCH_ALT,
    VIEW,
)

# --- fixed values: report groups and labels -----------------------------------------------------

FUNNEL_GROUPS = {
    "install": (INSTALL,),
    "open": (OPEN,),
    "search": (SEARCH, SEARCH_ALT),
    "viewcontent": (VIEW,),
    "addtocart": (CART, CART_ALT),
    "purchase": (PURCHASE,),
}
FUNNEL_RATES = ("search", "viewcontent", "addtocart", "purchase")

# Flag column -> (event code, label where set, label where not set).
VENN_FLAGS = {
    "has_viewcontent": (VIEW, "viewcontent", "not viewcontent"),
    "has_cart": (CART, "cart", "not cart"),
    "has_purchased": (PURCHASE, "purchase", "not purchase"),
}
VENN_CODES = (VIEW, CART, PURCHASE, IN_APP_PURCHASE)

WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def event_slice(
    events: DataFrame, condition: Column, n: int = 1, start: Day = None, end: Day = None
) -> DataFrame:
    """The first ``n`` events that meet ``condition``, in the order of all columns.

    Order and limit together keep only ``n`` rows per task.
    """
    return (
        events.where(between_dates("eventDate", start, end) & condition)
        .orderBy(*events.columns)
        .limit(n)
    )


def distinct_users(events_by_user: DataFrame, start: Day = None, end: Day = None) -> DataFrame:
    """Each user of each application once."""
    return (
        events_by_user.where(between_dates("event_date", start, end))
        .select("app_name", "c_id")
        .distinct()
    )


def active_days(events_by_user: DataFrame, start: Day = None, end: Day = None) -> DataFrame:
    """Users by number of days they were active on, with share and cumulative share in percent.

    The windows see one row per application and number of days.
    """
    per_user = (
        events_by_user.where(between_dates("event_date", start, end))
        .groupBy("app_name", "c_id")
        .agg(F.count_distinct("event_date").alias("event_day_count"))
    )
    per_days = per_user.groupBy("app_name", "event_day_count").agg(
        F.count("c_id").alias("user_count")
    )
    app = Window.partitionBy("app_name")
    up_to = app.orderBy("event_day_count").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    total = F.sum("user_count").over(app)
    return per_days.select(
        "app_name",
        "event_day_count",
        "user_count",
        ratio(100 * F.col("user_count"), total).alias("composition_ratio"),
        ratio(100 * F.sum("user_count").over(up_to), total).alias("cumulative_ratio"),
    )


def hourly_funnel(
    events_by_user: DataFrame,
    start: Day = None,
    end: Day = None,
    groups: Mapping[str, Sequence[str]] = FUNNEL_GROUPS,
    rates: Sequence[str] = FUNNEL_RATES,
) -> DataFrame:
    """Per date, hour, application and platform: users, mart rows, rows by event group, group rates.

    The distinct count is rewritten by the optimiser into an aggregation by user first, which
    carries the other counts along in the same shuffle.
    """
    counts = {
        name: F.count_if(F.col("event_typecode").isin(*codes)) for name, codes in groups.items()
    }
    return (
        events_by_user.where(between_dates("event_date", start, end))
        .groupBy("event_date", "event_hour", "app_name", "os_typecode")
        .agg(
            F.count_distinct("c_id").alias("user_count"),
            F.count("c_id").alias("user_access_count"),
            *(count.alias(name) for name, count in counts.items()),
        )
        .withColumns({
            f"{name}_per_user": ratio(F.col(name), F.col("user_count")) for name in rates
        })
    )


def event_venn(
    events_by_user: DataFrame,
    start: Day = None,
    end: Day = None,
    flags: Mapping[str, tuple[str, str, str]] = VENN_FLAGS,
    codes: Sequence[str] = VENN_CODES,
) -> DataFrame:
    """Users by combination of events they had, with all subtotals, and percent of all users.

    Users are counted per flag combination before the cube, so the cube multiplies a handful of rows
    per application and platform instead of the users. ``any`` marks a flag that is summed over. An
    event of ``codes`` without a flag counts its user in without setting one.
    """
    line = ["app_name", "os_typecode"]
    has = {name: F.col("event_typecode") == code for name, (code, _, _) in flags.items()}
    combinations = (
        events_by_user.where(
            between_dates("event_date", start, end)
            & F.col("event_typecode").isin(*codes)
            & F.col("app_name").isNotNull()
            & F.col("os_typecode").isNotNull()
        )
        .groupBy(*line, "c_id")
        .agg(*(F.max(condition).alias(name) for name, condition in has.items()))
        .groupBy(*line, *flags)
        .agg(F.count(F.lit(1)).alias("users"))
    )
    # A cube next to plain keys: every subset of the flags, always with the keys.
    subsets = [
        [name for bit, name in enumerate(flags) if kept >> bit & 1]
        for kept in range(2 ** len(flags))
    ]
    cubed = combinations.groupingSets(
        [[F.col(c) for c in (*line, *kept)] for kept in subsets],
        *(F.col(c) for c in (*line, *flags)),
    ).agg(
        F.sum("users").alias("user_count"),
        *(F.grouping(name).alias(f"{name}_summed") for name in flags),
    )
    all_summed = F.lit(True)
    for name in flags:
        all_summed = all_summed & (F.col(f"{name}_summed") == 1)
    everyone = F.max(F.when(all_summed, F.col("user_count"))).over(Window.partitionBy(*line))
    return cubed.select(
        *line,
        *(
            F.when(F.col(f"{name}_summed") == 1, "any")
            .when(F.col(name), is_set)
            .otherwise(not_set)
            .alias(name)
            for name, (_, is_set, not_set) in flags.items()
        ),
        "user_count",
        ratio(100 * F.col("user_count"), everyone).alias("ratio"),
    )


def weekday_by_hour(events_by_user: DataFrame, start: Day = None, end: Day = None) -> DataFrame:
    """Mart rows per application and hour, one column per weekday; NULL where there are none."""
    weekday = F.weekday("event_date")
    return (
        events_by_user.where(between_dates("event_date", start, end))
        .groupBy("app_name", "event_hour")
        .agg(*(
            F.nullif(F.count_if(weekday == number), F.lit(0)).alias(name.lower())
            for number, name in enumerate(WEEKDAYS)
        ))
    )


def slice_count(
    events_by_user: DataFrame,
    app: str,
    hour: str,
    weekday: str,
    start: Day = None,
    end: Day = None,
) -> DataFrame:
    """Mart rows of one application, hour and weekday: one cell of the weekday table, recounted."""
    return events_by_user.where(
        between_dates("event_date", start, end)
        & (F.col("app_name") == app)
        & (F.col("event_hour") == hour)
        & (F.weekday("event_date") == WEEKDAYS.index(weekday))
    ).agg(F.count(F.lit(1)).alias("row_count"))
