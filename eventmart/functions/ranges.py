"""Date filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

Day = dt.date | str | None


def as_date(day: Day) -> dt.date | None:
    """A ``date`` from a date or from text like ``2021-01-31``."""
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def between_dates(column: str, start: Day = None, end: Day = None) -> Column:
    """Closed date range as typed literals, so that it is pushed to the scan; open where None."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (F.col(column) >= F.lit(as_date(start)))
    if end is not None:
        condition = condition & (F.col(column) <= F.lit(as_date(end)))
    return condition
