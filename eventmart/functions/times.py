"""Epoch numbers, wall clocks and second differences, none of which depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventmart.functions.numbers import to_long

# Years 1 to 9999; outside of it a number is a broken clock and Spark's constructors would raise.
_FIRST_SECOND = -62_135_596_800
_LAST_SECOND = 253_402_300_799

_PER_SECOND = {"s": 1, "ms": 1000}
_DAY = 86_400


def epoch_seconds(number: Column, unit: str) -> Column:
    """Whole seconds since 1970 of an epoch number in ``s`` or ``ms``; NULL if unreadable."""
    seconds = to_long(number.try_cast("double") / _PER_SECOND[unit])
    return F.when(seconds.between(_FIRST_SECOND, _LAST_SECOND), seconds)


def _local_seconds(moment: Column, tz: str) -> Column:
    """Seconds since 1970 that a clock in ``tz`` shows; plain number arithmetic from here on."""
    return F.unix_seconds(F.from_utc_timestamp(moment, tz))


def local_date(moment: Column, tz: str) -> Column:
    """Date of an instant in ``tz``."""
    return F.date_from_unix_date(F.floor(_local_seconds(moment, tz) / _DAY).cast("int"))


def local_hour(moment: Column, tz: str) -> Column:
    """Hour of day of an instant in ``tz``, as two digits."""
    hour = F.floor(F.pmod(_local_seconds(moment, tz), F.lit(_DAY)) / 3600)
    return F.lpad(hour.cast("string"), 2, "0")


def epoch_cols(number: Column, unit: str, tz: str) -> tuple[Column, Column, Column]:
    """Instant, local date and local two-digit hour of an epoch number."""
    moment = F.timestamp_seconds(epoch_seconds(number, unit))
    return moment, local_date(moment, tz), local_hour(moment, tz)


def wall_clock(moment: Column, tz: str) -> Column:
    """Local time of an instant in ``tz``, to the second, as a timestamp without time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", _local_seconds(moment, tz), epoch)


def instant(local: Column, tz: str) -> Column:
    """The instant of a timestamp without time zone that a clock in ``tz`` showed, to the second."""
    return F.to_utc_timestamp(F.timestamp_seconds(F.unix_timestamp(local)), tz)


def second_diff(later: Column, earlier: Column) -> Column:
    """Seconds from ``earlier`` to ``later``; both are cut to whole seconds first."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)
