"""Column functions that give the same result with ANSI mode on and off and in any session time zone."""

from eventmart.functions.codes import device_id, event_code, os_code
from eventmart.functions.numbers import first_item, json_item, ratio, to_int, to_long
from eventmart.functions.ranges import between_dates
from eventmart.functions.times import (
    epoch_cols,
    epoch_seconds,
    instant,
    local_date,
    local_hour,
    second_diff,
    wall_clock,
)

__all__ = [
    "between_dates", "device_id", "epoch_cols", "epoch_seconds", "event_code", "first_item", "instant",
    "json_item", "local_date", "local_hour", "os_code", "ratio", "second_diff", "to_int", "to_long",
    "wall_clock",
]
