"""Sales reports.

The windows run over daily or monthly sums, so the longest partition is one application and platform
with one row per day: its length grows with time covered, not with the number of purchases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions import between_dates
from eventmart.functions.ranges import Day
from eventmart.schemas import PURCHASE

_LINE = ("app_name", "os_typecode")


def sales_by_event_time(events: DataFrame, start: Day = None, end: Day = None) -> DataFrame:
    """Count, value, amount and average amount per application, platform and event second.

    The range is on the stored event date, which unlike a date made from the timestamp reaches the
    scan as a filter.
    """
    return (
        events.where(between_dates("eventDate", start, end))
        .groupBy("trackingId", "osTypeCode", "eventTimeStamp")
        .agg(
            F.count("amount").alias("purchased_count"),
            F.sum("value").alias("total_value"),
            F.sum("amount").alias("total_amount"),
            F.avg("amount").alias("avg_amount"),
        )
    )


def daily_sales(purchases: DataFrame, start: Day = None, end: Day = None) -> DataFrame:
    """Per application, platform and day: mart rows, amount, and average amount per mart row."""
    return (
        purchases.where(between_dates("event_date", start, end))
        .groupBy(*_LINE, "event_date")
        .agg(
            F.count("amount_total").alias("purchase_count"),
            F.sum("amount_total").alias("amount_total"),
            F.round(F.avg("amount_total"), 2).alias("amount_avg"),
        )
    )


def _daily_amount(purchases: DataFrame, start: Day, end: Day) -> DataFrame:
    return (
        purchases.where(between_dates("event_date", start, end))
        .groupBy(*_LINE, "event_date")
        .agg(F.sum("amount_total").alias("amount_total"))
    )


def moving_avg(
    purchases: DataFrame, start: Day = None, end: Day = None, n: int = 7
) -> DataFrame:
    """Average over the last ``n`` days with sales, NULL until there are ``n``; and its whole part.

    The frame counts days with sales, so a day without any does not interrupt it.
    """
    last_n = Window.partitionBy(*_LINE).orderBy("event_date").rowsBetween(1 - n, 0)
    full = F.count(F.lit(1)).over(last_n) == n
    average = f"amount_avg_{n}day"
    return (
        _daily_amount(purchases, start, end)
        .withColumn(average, F.when(full, F.avg("amount_total").over(last_n)))
        .withColumn("avg", F.col(average).cast("bigint"))
    )


def running_total(purchases: DataFrame, start: Day = None, end: Day = None) -> DataFrame:
    """Daily amount and its running total."""
    so_far = (
        Window.partitionBy(*_LINE)
        .orderBy("event_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return _daily_amount(purchases, start, end).withColumn(
        "amount_agg", F.sum("amount_total").over(so_far)
    )


def month_over_month(purchases: DataFrame, year: int | None = None) -> DataFrame:
    """Monthly amount, that of the previous month with sales, and the difference.

    ``year`` limits the months; it is turned into a date range, which reaches the scan.
    """
    if year is not None:
        in_year = between_dates("event_date", f"{year:04d}-01-01", f"{year:04d}-12-31")
        purchases = purchases.where(in_year)
    months = Window.partitionBy(*_LINE).orderBy("event_year", "event_month")
    return (
        purchases.where(F.col("app_name") != "")
        .groupBy(*_LINE, "event_year", "event_month")
        .agg(F.sum("amount_total").alias("amount_total"))
        .withColumn("pre_amount", F.lag("amount_total").over(months))
        .withColumn("diff_amount", F.col("amount_total") - F.col("pre_amount"))
    )


def price_histogram(
    events: DataFrame,
    lo: int = 0,
    hi: int = 10_000_000,
    buckets: int = 10,
    min_price: int = 100,
    codes: Sequence[str] = (PURCHASE,),
    start: Day = None,
    end: Day = None,
) -> DataFrame:
    """Purchases by price in ``buckets`` equal steps of [lo, hi): limits, count and sum.

    Prices from above ``min_price`` up to and including ``hi`` count; ``hi`` itself falls into
    bucket ``buckets + 1``.
    """
    width = (hi - lo) / buckets
    price = F.col("value")
    bucket = F.width_bucket(price, F.lit(lo), F.lit(hi), F.lit(buckets))
    return (
        events.where(
            between_dates("eventDate", start, end)
            & (price > min_price)
            & (price <= hi)
            & F.col("trackingEventCode").isin(*codes)
        )
        .groupBy(bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("num_purchase"), F.sum("value").alias("total_amount"))
        .select(
            "bucket",
            (lo + width * (F.col("bucket") - 1)).alias("lower_limit"),
            (lo + width * F.col("bucket")).alias("upper_limit"),
            "num_purchase",
            "total_amount",
        )
    )
