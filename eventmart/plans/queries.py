"""Every operator as a query over the test tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import operators as ops
from eventmart.functions import (
    device_id,
    epoch_cols,
    event_code,
    os_code,
    second_diff,
    wall_clock,
)
from eventmart.functions.ranges import as_date
from eventmart.operators.standardize import field
from eventmart.plans.adapters import (
    faulty_lines,
    purchase_mart,
    raw_lines,
    raw_logs,
    standard_events,
    standardized_logs,
    with_instants,
    with_wall_clocks,
)
from eventmart.plans.jobs import Lake, catch_up, standardize_days
from eventmart.schemas import EVENT_BY_USER, RAW_FOLDER, RAW_QUALITY, TIER1, TIER1_STORED, VENDORS, stored
from eventmart.sources import (
    missing_days,
    read_raw,
    read_tier,
    relayout,
    shared_folder,
    write_sorted,
    write_tier1,
    write_tier2,
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# The raw folder day and the run day the test events are stored under.
RUN_DAY = "2024-01-30"


def query(name: str) -> Callable[[Query], Query]:
    """Register a function as the query of that name."""

    def register(function: Query) -> Query:
        _QUERIES[name] = function
        return function

    return register


def queries() -> dict[str, Query]:
    """All queries by name."""
    return dict(_QUERIES)


# --- raw logs and standardisation ----------------------------------------------------------------


@query("raw_scan")
def raw_scan(spark, sf_dir):
    root = shared_folder(spark, "raw")
    logs = []
    for vendor in VENDORS:
        folder = RAW_FOLDER.format(vendor=vendor.lower(), day=as_date(RUN_DAY))
        raw_lines(spark, sf_dir, vendor).write.text(f"{root}/{folder}")
        raw = read_raw(spark, vendor, root, [RUN_DAY])
        app, name, when = {
            "ADBRIX": ("package_name", "activity", "event_time"),
            "BRANCH": ("organization_name", "name", "event_timestamp"),
            "SINGULAR": ("app_name", "evtname", "utc"),
        }[vendor]
        logs.append(raw.select(
            F.lit(vendor).alias("tracking"),
            F.col("logTimeStamp").alias("log_time"),
            field(app).alias("app"),
            field(name).alias("event_name"),
            field(when).alias("event_time"),
            "run_date",
        ))
    return functools.reduce(DataFrame.unionByName, logs)


def _standardized(vendor: str) -> Query:
    def run(spark, sf_dir):
        return with_wall_clocks(ops.standardize(raw_logs(spark, sf_dir, vendor), vendor))

    return run


for _vendor in VENDORS:
    query(f"standardize_{_vendor.lower()}")(_standardized(_vendor))


@query("union_events")
def union_events(spark, sf_dir):
    return with_wall_clocks(standardized_logs(spark, sf_dir))


@query("drop_no_app")
def drop_no_app(spark, sf_dir):
    return (
        standardized_logs(spark, sf_dir)
        .groupBy("tracking", "trackingId", "osTypeCode")
        .agg(F.count(F.lit(1)).alias("kept"))
    )


def _per_vendor(spark, sf_dir, columns) -> DataFrame:
    """Counts of the columns that ``columns(vendor)`` gives, over all vendors' raw logs."""
    return functools.reduce(DataFrame.unionByName, (
        raw_logs(spark, sf_dir, vendor)
        .groupBy(F.lit(vendor).alias("tracking"), *columns(vendor))
        .agg(F.count(F.lit(1)).alias("lines"))
        for vendor in VENDORS
    ))


_NAME = {"ADBRIX": "activity", "BRANCH": "name", "SINGULAR": "evtname"}
_PLATFORM = {"ADBRIX": "platform", "BRANCH": "ud_os", "SINGULAR": "platform"}


@query("event_code_map")
def event_code_map(spark, sf_dir):
    def columns(vendor):
        name = field(_NAME[vendor])
        return name.alias("event_name"), event_code(vendor, name).alias("event_code")

    return _per_vendor(spark, sf_dir, columns)


@query("os_code_map")
def os_code_map(spark, sf_dir):
    def columns(vendor):
        platform = field(_PLATFORM[vendor])
        return platform.alias("platform"), os_code(vendor, platform).alias("os_code")

    return _per_vendor(spark, sf_dir, columns)


@query("device_id")
def device_ids(spark, sf_dir):
    def columns(vendor):
        return (
            field(_PLATFORM[vendor]).alias("platform"),
            device_id(vendor, field).alias("device_id"),
        )

    return _per_vendor(spark, sf_dir, columns)


@query("epoch_to_time")
def epoch_to_time(spark, sf_dir):
    def columns(name, unit):
        moment, date, hour = epoch_cols(field(name), unit, "Asia/Seoul")
        return (
            wall_clock(moment, "UTC").alias("moment"),
            date.alias("local_date"),
            hour.alias("local_hour"),
        )

    seconds = raw_logs(spark, sf_dir, "SINGULAR").select(
        F.lit("s").alias("unit"), *columns("utc", "s")
    )
    millis = raw_logs(spark, sf_dir, "BRANCH").select(
        F.lit("ms").alias("unit"), *columns("event_timestamp", "ms")
    )
    return seconds.unionByName(millis)


@query("json_attrs")
def json_attrs(spark, sf_dir):
    return ops.standardize(raw_logs(spark, sf_dir, "SINGULAR"), "SINGULAR").select(
        "trackingEventCode", "contentId", "contentName", "value", "quantity"
    )


@query("next_event_time")
def next_event_time(spark, sf_dir):
    return ops.with_next_event(standard_events(spark, sf_dir)).select(
        "tracking", "trackingId", "cid", "osTypeCode", "eventTimeStamp", "nextEventTimeStamp"
    )


@query("partition_columns")
def partition_columns(spark, sf_dir):
    return ops.with_partition_columns(standardized_logs(spark, sf_dir)).select(
        "tracking", "trackingId", "cid", "eventDate", "eventHour", "date", "hour"
    )


# --- stored tables ---------------------------------------------------------------------------------


def _made_once(spark, rows: DataFrame, purpose: str) -> DataFrame:
    """Rows that are written several times, stored, so that the JSON they come from is made and parsed once."""
    path = shared_folder(spark, purpose)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@query("tier1_write")
def tier1_write(spark, sf_dir):
    """Written, and written again as a re-run would: the rows are there once."""
    root = shared_folder(spark, "tier1")
    events = _made_once(spark, standardized_logs(spark, sf_dir), "standardized")
    write_tier1(events, root, RUN_DAY)
    write_tier1(events, root, RUN_DAY)
    return with_wall_clocks(read_tier(spark, root, schema=TIER1_STORED))


@query("tier_scan")
def tier_scan(spark, sf_dir):
    root = shared_folder(spark, "tier1")
    write_tier1(with_instants(standard_events(spark, sf_dir)), root, RUN_DAY)
    days = read_tier(spark, root, "2024-01-05", "2024-01-20", TIER1_STORED)
    return with_wall_clocks(days).select(*TIER1.names, "hour", "date")


@query("tier2_write")
def tier2_write(spark, sf_dir):
    root = shared_folder(spark, "tier2")
    write_tier2(ops.event_by_user(standard_events(spark, sf_dir)), root)
    return read_tier(spark, root, schema=stored(EVENT_BY_USER))


@query("tuned_parquet_write")
def tuned_parquet_write(spark, sf_dir):
    path = shared_folder(spark, "sorted")
    events = with_instants(standard_events(spark, sf_dir))
    write_sorted(events, path, "eventTimeStamp", files=20)
    return with_wall_clocks(spark.read.schema(TIER1).parquet(path))


@query("relayout")
def relayout_runs(spark, sf_dir):
    """Events of two runs in run folders, the second run holding the purchases, under one root."""
    src, dst = shared_folder(spark, "runs"), shared_folder(spark, "tier1")
    events = ops.with_partition_columns(with_instants(standard_events(spark, sf_dir)))
    is_purchase = F.col("trackingEventCode") == "TPD004"
    for run, part in ((RUN_DAY, events.where(~is_purchase)), ("2024-01-31", events.where(is_purchase))):
        part.write.partitionBy("date").parquet(f"{src}/{run}")
    relayout(spark, src, dst)
    return with_wall_clocks(read_tier(spark, dst, schema=TIER1_STORED)).select(
        *TIER1.names, "hour", "date", "run_date"
    )


@query("missing_days")
def missing(spark, sf_dir):
    root = shared_folder(spark, "tier1")
    write_tier1(with_instants(standard_events(spark, sf_dir)), root, RUN_DAY)
    return missing_days(
        spark, read_tier(spark, root, schema=TIER1_STORED), "2023-12-01", "2024-12-31"
    )


@query("catch_up_marts")
def catch_up_marts(spark, sf_dir):
    """The event mart after half of the lines have come in one hour and, that half again in new files, the rest in the next."""
    root = shared_folder(spark, "lake")
    lake = Lake(f"{root}/raw", f"{root}/warehouse")
    # The hour is a column, not a filter on the line: that would be pushed down and make each line twice.
    made = [
        raw_lines(spark, sf_dir, vendor).select(F.lit(vendor).alias("vendor"), "value", F.pmod(F.xxhash64("value"), F.lit(2)).alias("hour"))
        for vendor in VENDORS
    ]
    lines = _made_once(spark, functools.reduce(DataFrame.unionByName, made), "lines")
    for hours in (1, 2):
        for vendor in VENDORS:
            folder = f"{lake.raw}/{RAW_FOLDER.format(vendor=vendor.lower(), day=as_date(RUN_DAY))}"
            for hour in range(hours):
                part = lines.where((F.col("vendor") == vendor) & (F.col("hour") == hour)).select("value")
                part.write.mode("overwrite").text(f"{folder}/{hour:02d}")
        catch_up(spark, lake, RUN_DAY, RUN_DAY)
    return read_tier(spark, lake.event_by_user, schema=stored(EVENT_BY_USER))


@query("raw_quality")
def raw_quality(spark, sf_dir):
    """Stored counts of lines by fault, after a run over lines some of which are faulty."""
    root = shared_folder(spark, "lake")
    lake = Lake(f"{root}/raw", f"{root}/warehouse")
    for vendor in VENDORS:
        folder = RAW_FOLDER.format(vendor=vendor.lower(), day=as_date(RUN_DAY))
        faulty_lines(spark, sf_dir, vendor).write.text(f"{lake.raw}/{folder}")
    standardize_days(spark, lake, [RUN_DAY])
    return spark.read.schema(RAW_QUALITY).parquet(lake.raw_quality)


# --- marts -----------------------------------------------------------------------------------------


@query("event_by_user")
def event_by_user(spark, sf_dir):
    return ops.event_by_user(standard_events(spark, sf_dir))


@query("event_by_user_daily")
def event_by_user_daily(spark, sf_dir):
    return ops.event_by_user_daily(standard_events(spark, sf_dir))


@query("purchase_by_user")
def purchase_by_user(spark, sf_dir):
    return ops.purchase_by_user(standard_events(spark, sf_dir))


@query("purchase_by_user_from_ts")
def purchase_by_user_from_ts(spark, sf_dir):
    return ops.purchase_by_user_from_ts(standard_events(spark, sf_dir))


@query("purchase_by_user_from_ts_in_range")
def purchase_by_user_from_ts_in_range(spark, sf_dir):
    events = standard_events(spark, sf_dir)
    return ops.purchase_by_user_from_ts(events, "2024-01-05", "2024-01-20", prune=True)


def _user_mart(spark, sf_dir) -> DataFrame:
    return ops.event_by_user(standard_events(spark, sf_dir))


# --- reports ---------------------------------------------------------------------------------------


@query("sales_by_event_time")
def sales_by_event_time(spark, sf_dir):
    return ops.sales_by_event_time(standard_events(spark, sf_dir), "2024-01-01", "2024-12-31")


@query("daily_sales")
def daily_sales(spark, sf_dir):
    return ops.daily_sales(purchase_mart(spark, sf_dir), "1995-01-01", "2002-01-01")


@query("moving_avg_7")
def moving_avg_7(spark, sf_dir):
    return ops.moving_avg(purchase_mart(spark, sf_dir), "1995-01-01", "2002-01-01")


@query("running_total")
def running_total(spark, sf_dir):
    return ops.running_total(purchase_mart(spark, sf_dir), "1995-01-01", "2002-01-01")


@query("month_over_month")
def month_over_month(spark, sf_dir):
    return ops.month_over_month(purchase_mart(spark, sf_dir))


@query("price_histogram")
def price_histogram(spark, sf_dir):
    return ops.price_histogram(standard_events(spark, sf_dir), lo=0, hi=400, min_price=10)


@query("price_histogram_items")
def price_histogram_items(spark, sf_dir):
    """Line item prices: every item is a purchase."""
    items = purchase_mart(spark, sf_dir).select(
        F.col("amount_total").alias("value"),
        F.col("event_date").alias("eventDate"),
        F.lit("TPD004").alias("trackingEventCode"),
    )
    return ops.price_histogram(items, lo=0, hi=100_000)


@query("event_slice")
def event_slice(spark, sf_dir):
    events = standard_events(spark, sf_dir)
    wanted = (F.col("trackingEventCode") == "TPD004") & (F.col("value") > 1) & (F.col("value") == 2)
    return ops.event_slice(events, wanted, 1, "2024-01-01", "2024-12-31")


@query("distinct_users")
def distinct_users(spark, sf_dir):
    return ops.distinct_users(_user_mart(spark, sf_dir), "2024-01-01", "2024-12-31")


@query("active_days")
def active_days(spark, sf_dir):
    return ops.active_days(_user_mart(spark, sf_dir), "2024-01-01", "2024-12-31")


@query("hourly_funnel")
def hourly_funnel(spark, sf_dir):
    return ops.hourly_funnel(_user_mart(spark, sf_dir), "2024-01-01", "2024-12-31")


@query("event_venn")
def event_venn(spark, sf_dir):
    return ops.event_venn(_user_mart(spark, sf_dir), "2024-01-01", "2024-12-31")


@query("weekday_by_hour")
def weekday_by_hour(spark, sf_dir):
    return ops.weekday_by_hour(_user_mart(spark, sf_dir), "2024-01-01", "2024-12-31")


@query("slice_count")
def slice_count(spark, sf_dir):
    return ops.slice_count(
        _user_mart(spark, sf_dir), "app_1", "00", "Mon", "2024-01-01", "2024-12-31"
    )


@query("cart_lead_time")
def cart_lead_time(spark, sf_dir):
    return ops.cart_lead_time(standard_events(spark, sf_dir), "2024-01-01", "2024-12-31")


@query("post_signup_events")
def post_signup_events(spark, sf_dir):
    return ops.post_signup_events(_user_mart(spark, sf_dir), "2024-01-01", "2024-12-31")


@query("signup_retention")
def signup_retention(spark, sf_dir):
    return ops.signup_retention(_user_mart(spark, sf_dir), "2024-01-01", "2024-12-31")


# --- scalar checks ---------------------------------------------------------------------------------


@query("cast_avg_bigint")
def cast_avg_bigint(spark, sf_dir):
    return (
        purchase_mart(spark, sf_dir)
        .groupBy("app_name")
        .agg(F.avg("amount_total").cast("bigint").alias("amount_avg"))
    )


@query("date_diff_days")
def date_diff_days(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lag = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    return (
        items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(lag.alias("ship_days"))
        .agg(F.count(F.lit(1)).alias("items"))
    )


@query("round_2")
def round_2(spark, sf_dir):
    discount = F.col("l_extendedprice") * F.col("l_discount")
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", F.round(discount, 2).alias("discount")
    )


@query("second_diff")
def second_diffs(spark, sf_dir):
    ts = F.col("ts")
    return (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .groupBy("user_id")
        .agg(second_diff(F.max(ts), F.min(ts)).alias("active_seconds"))
    )
