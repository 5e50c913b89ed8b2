"""Reports that follow a user over time: cart to purchase, sign-up to later days."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions import between_dates, second_diff
from eventmart.functions.ranges import Day
from eventmart.schemas import (
    CART,
    OTHER_OS,
    PURCHASE,
    PURCHASE_CODE_BY_APP,
    SIGN_UP,
    ZERO_ID,
)

# --- fixed values: lead time steps and retention label -----------------------------------------

LEAD_TIME_HOURS = (1, 6, 24, 48)
REPEAT_LABEL = "{:02d} day repeat"


def _purchase_code(by_app: Mapping[str, str]) -> Column:
    code = F.lit(PURCHASE)
    for app, own in by_app.items():
        code = F.when(F.col("trackingId") == app, own).otherwise(code)
    return code


def cart_lead_time(
    events: DataFrame,
    start: Day = None,
    end: Day = None,
    cart_codes: Sequence[str] = (CART,),
    purchase_code_by_app: Mapping[str, str] = PURCHASE_CODE_BY_APP,
    hours: Sequence[int] = LEAD_TIME_HOURS,
) -> DataFrame:
    """How soon content put into the cart is bought, per application, platform and cart date.

    A user's first cart and first purchase of a content are compared. Bought before it was put into
    the cart counts as within every limit; a purchase without a cart is in the row with no cart
    date. ``add_cart`` counts all pairs of user and content in the row.
    """
    code = F.col("trackingEventCode")
    in_cart = code.isin(*cart_codes)
    scanned = [*cart_codes, PURCHASE, *purchase_code_by_app.values()]
    pairs = (
        events.where(
            between_dates("eventDate", start, end)
            & (F.col("osTypeCode") != OTHER_OS)
            & code.isin(*dict.fromkeys(scanned))
            & (in_cart | (code == _purchase_code(purchase_code_by_app)))
        )
        .groupBy(
            F.col("trackingId").alias("app_name"),
            F.col("osTypeCode").alias("os_typecode"),
            F.col("cid").alias("c_id"),
            F.col("contentId").alias("content_id"),
        )
        .agg(
            F.min(F.when(in_cart, F.col("eventDate"))).alias("add_cart_date"),
            F.min(F.when(~in_cart, F.col("eventDate"))).alias("purchase_date"),
            F.min(F.when(in_cart, F.col("eventTimeStamp"))).alias("cart_time"),
            F.min(F.when(~in_cart, F.col("eventTimeStamp"))).alias("purchase_time"),
        )
        .withColumn("lead_time", second_diff(F.col("purchase_time"), F.col("cart_time")))
    )
    flags = {
        f"purchase_{limit}_hour": F.coalesce(F.col("lead_time") <= limit * 3600, F.lit(False))
        for limit in hours
    } | {
        "not_purchase": F.col("purchase_date").isNull(),
        "not_add_cart_purchase": F.col("lead_time").isNull() & F.col("purchase_date").isNotNull(),
    }
    totals = []
    for name, flag in flags.items():
        totals.append(F.count_if(flag).alias(name))
        totals.append(F.round(F.avg(flag.cast("int")), 2).alias(f"{name}_rate"))
    return pairs.groupBy("app_name", "os_typecode", "add_cart_date").agg(
        F.count(F.lit(1)).alias("add_cart"), *totals
    )


# Equal rows are written out in portions of this many.
_PORTION = 10_000


def _known_devices(events_by_user: DataFrame, start: Day, end: Day) -> DataFrame:
    """Mart rows in range without the id that all devices with tracking switched off share."""
    return events_by_user.where(
        between_dates("event_date", start, end) & (F.col("c_id") != ZERO_ID)
    )


def post_signup_events(
    events_by_user: DataFrame,
    start: Day = None,
    end: Day = None,
    signup_code: str = SIGN_UP,
) -> DataFrame:
    """Sign-up rows with the same user's mart rows on and after the sign-up date.

    The mart holds one row per hour, so a user with sign-ups in two hours is listed twice. Rows that
    would look the same are counted on both sides first and written out last, in portions: what is joined
    of one user is bounded by the days covered. Rows of users who never sign up are removed before anything else.
    """
    seen = _known_devices(events_by_user, start, end)
    signups = (
        seen.where(F.col("event_typecode") == signup_code)
        .groupBy("app_name", "c_id", F.col("event_date").alias("register_date"))
        .agg(F.count(F.lit(1)).alias("signup_rows"))
    )
    user_days = (
        seen.select("app_name", "c_id", "event_typecode", "event_date")
        .join(signups.select("app_name", "c_id").distinct(), ["app_name", "c_id"], "left_semi")
        .groupBy("app_name", "c_id", "event_typecode", "event_date")
        .agg(F.count(F.lit(1)).alias("event_rows"))
    )
    times = F.col("signup_rows") * F.col("event_rows")
    portions = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("times") - 1) / _PORTION))
    size = F.least(F.col("times") - F.col("portion") * _PORTION, F.lit(_PORTION)).cast("int")
    return (
        signups.join(user_days, ["app_name", "c_id"])
        .where(F.col("event_date") >= F.col("register_date"))
        .select(
            "app_name",
            "c_id",
            "register_date",
            "event_typecode",
            "event_date",
            times.alias("times"),
        )
        .withColumn("portion", F.explode(portions))
        .withColumn("listed", F.explode(F.array_repeat(F.lit(True), size)))
        .drop("times", "portion", "listed")
    )


def signup_retention(
    events_by_user: DataFrame,
    start: Day = None,
    end: Day = None,
    days: int = 7,
    signup_code: str = SIGN_UP,
) -> DataFrame:
    """Percent of users seen again on day 1 to ``days`` after sign-up, per application and date.

    A day past the user's last event in range cannot be judged and leaves the user out of that day's
    average. Users who never sign up are removed before anything is sorted; the rest is one window
    pass over a user's distinct days, which looks ahead no further than ``days``. The days after
    sign-up become rows only after aggregation.
    """
    seen = _known_devices(events_by_user, start, end)
    signed_up = F.col("event_typecode") == signup_code
    newcomers = seen.where(signed_up).select("app_name", "c_id").distinct()
    user_days = (
        seen.join(newcomers, ["app_name", "c_id"], "left_semi")
        .groupBy("app_name", "c_id", "event_date")
        .agg(F.max(signed_up).alias("is_signup"))
        .withColumn("day_number", F.unix_date("event_date"))
    )
    user = Window.partitionBy("app_name", "c_id")
    ahead = user.orderBy("day_number").rangeBetween(1, days)
    signups = user_days.select(
        "app_name",
        F.col("event_date").alias("register_date"),
        "is_signup",
        "day_number",
        F.collect_list("day_number").over(ahead).alias("seen_ahead"),
        F.max("day_number").over(user).alias("last_day"),
    ).where("is_signup")

    def came_back(offset: int) -> Column:
        index_day = F.col("day_number") + offset
        flag = F.array_contains("seen_ahead", index_day).cast("double")
        return F.when(index_day <= F.col("last_day"), flag)

    return (
        signups.groupBy("app_name", "register_date")
        .agg(F.array(*(
            F.struct(
                F.lit(REPEAT_LABEL.format(offset)).alias("index_name"),
                F.round(F.avg(100 * came_back(offset)), 2).alias("repeat_rate"),
            )
            for offset in range(1, days + 1)
        )).alias("offsets"))
        .select("app_name", "register_date", F.inline("offsets"))
    )
