"""The time of the next event, without a window over a user's events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

USER_KEYS = ("tracking", "trackingId", "cid", "osTypeCode")
MOMENT = "eventTimeStamp"

# Identical copies are written back in portions of this many rows.
_PORTION = 10_000


def with_next_event(events: DataFrame) -> DataFrame:
    """Every event with the time of the same user's next one, NULL after the last.

    One id may stand for a large share of all events (devices with tracking switched off share one),
    so a window over a user's events could put all of those into one task. But event times are whole
    seconds: among a user's events of one second, all but one are followed by that same second, and
    the one left over by the user's next second. So:

    1. events are counted per user, second and content (combined before the shuffle), and each of a user's
       seconds is given the next one in two windows: within an hour, where a second is one row however many
       events it holds, and from an hour's last second to the next hour with events, where an hour is one
       row. So the longest window of a user who is always active has an hour's seconds, or all hours;
    2. events are joined to that by user and second, where the adaptive skew join splits a hot key;
       the second's event with the largest content hash takes the next second;
    3. where that event has identical copies, these are counted, one takes the next second and the
       others are written back in portions, spread over tasks.
    """
    columns = events.columns
    key = (*USER_KEYS, MOMENT)
    # NULLs leave a hash as it is, so which columns are NULL is hashed too.
    content = F.xxhash64(*columns, *(F.col(c).isNull() for c in columns))
    hashed = events.withColumn("_content", content)

    seconds = (
        hashed.groupBy(*key, "_content")
        .agg(F.count(F.lit(1)).alias("_copies"))
        .groupBy(*(F.col(c).alias(f"_{c}") for c in key))
        .agg(
            F.max("_content").alias("_last_content"),
            F.max_by("_copies", "_content").alias("_last_copies"),
        )
    )
    seconds = _with_next_second(seconds)

    same_second = F.lit(True)
    for c in key:
        same_second = same_second & F.col(c).eqNullSafe(F.col(f"_{c}"))
    # Written so that it does not become a join key: both joins below then read one shuffle of events.
    is_last = F.col("_content").bitwiseXOR(F.col("_last_content")) == 0
    next_or_same = F.when(is_last, F.col("nextEventTimeStamp")).otherwise(F.col(MOMENT))

    single = (
        hashed.join(seconds, same_second)
        .where(~is_last | (F.col("_last_copies") == 1))
        .select(next_or_same.alias("nextEventTimeStamp"), *columns)
    )
    copied = (
        hashed.join(seconds.where(F.col("_last_copies") > 1), same_second & is_last)
        .groupBy("nextEventTimeStamp", *columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    one_of_copies = copied.select("nextEventTimeStamp", *columns)
    return single.unionByName(one_of_copies).unionByName(_other_copies(copied, columns))


def _with_next_second(seconds: DataFrame) -> DataFrame:
    """Distinct seconds of users with the user's next second, by hours first and then from hour to hour."""
    users, moment, following = [f"_{c}" for c in USER_KEYS], f"_{MOMENT}", "nextEventTimeStamp"
    hour = Window.partitionBy(*users, "_hour")
    columns = seconds.columns
    hourly = seconds.withColumn("_hour", F.floor(F.unix_timestamp(moment) / 3600)).withColumns({
        following: F.lead(moment).over(hour.orderBy(moment)),
        "_first": F.min(moment).over(hour.orderBy(moment)),
    })
    within = hourly.where(F.col(following).isNotNull())
    # One row per hour is left; events without a time come first, as an hour of their own.
    to_next_hour = F.lead("_first").over(Window.partitionBy(*users).orderBy("_hour"))
    last = hourly.where(F.col(following).isNull()).withColumn(following, to_next_hour)
    return within.select(*columns, following).unionByName(last.select(*columns, following))


def _other_copies(copied: DataFrame, columns: list[str]) -> DataFrame:
    """All copies but one, each followed by its own second."""
    others = F.col("_copies") - 1
    portions = F.sequence(F.lit(0).cast("bigint"), F.floor((others - 1) / _PORTION))
    size = F.least(others - F.col("_portion") * _PORTION, F.lit(_PORTION)).cast("int")
    return (
        copied.where(others > 0)
        .withColumn("_portion", F.explode(portions))
        .repartition(F.xxhash64(*columns), "_portion")
        .withColumn("_written", F.explode(F.array_repeat(F.lit(True), size)))
        .select(F.col(MOMENT).alias("nextEventTimeStamp"), *columns)
    )
