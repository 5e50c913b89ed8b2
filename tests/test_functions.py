"""Time functions across time zones and clock changes."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from eventmart.functions import epoch_cols, instant, local_date, to_int, wall_clock

MOMENTS = [
    "1969-12-31 23:59:59", "1970-01-01 00:00:00", "2021-03-14 06:59:59", "2021-03-14 07:00:00",
    "2021-07-01 03:30:00", "2021-11-07 05:30:00", "2021-11-07 06:30:00", "2024-02-29 15:00:00",
]


@pytest.mark.parametrize("tz", ["UTC", "Asia/Seoul", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("session_tz", ["UTC", "America/New_York"])
def test_local_date_and_hour(spark, ansi, tz, session_tz):
    moments = [dt.datetime.fromisoformat(m).replace(tzinfo=dt.timezone.utc) for m in MOMENTS]
    frame = spark.createDataFrame([(int(m.timestamp()),) for m in moments], "s long")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_tz)
    try:
        for unit, number in (("s", F.col("s").cast("string")), ("ms", F.col("s") * 1000 + 0)):
            moment, date, hour = epoch_cols(number, unit, tz)
            rows = frame.select(
                F.unix_seconds(moment).alias("seconds"), date.alias("date"), hour.alias("hour"),
                wall_clock(moment, tz).alias("clock"), local_date(moment, tz).alias("again"),
            ).collect()
            for row, expected in zip(rows, moments):
                local = expected.astimezone(ZoneInfo(tz))
                assert row.seconds == expected.timestamp()
                assert row.date == row.again == local.date()
                assert row.hour == f"{local:%H}"
                assert row.clock == local.replace(tzinfo=None)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_instant_is_the_inverse_of_wall_clock(spark):
    frame = spark.createDataFrame([(1625140800,), (1609459200,)], "s long")
    there = wall_clock(F.timestamp_seconds("s"), "Asia/Seoul")
    rows = frame.select("s", F.unix_seconds(instant(there, "Asia/Seoul")).alias("back")).collect()
    assert all(row.s == row.back for row in rows)


@pytest.mark.parametrize(
    ("text", "number"),
    [("10", 10), ("10.9", 10), ("-10.9", -10), (" 7 ", 7), ("1e3", 1000), ("", None), ("x", None),
     ("NaN", None), ("Infinity", None), ("2147483648", None), ("2147483647", 2147483647), (None, None)],
)
def test_to_int(spark, ansi, text, number):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(to_int(F.col("t"))).collect()[0][0] == number
