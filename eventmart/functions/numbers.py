"""Reading numbers and items out of loosely typed vendor fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_item(array: Column) -> Column:
    """Element 0 of an array, NULL where the array is NULL or empty."""
    return F.get(array, F.lit(0))


def json_item(text: Column, field: str) -> Column:
    """Field of the first object in a JSON array of objects, as text."""
    return F.get_json_object(text, f"$[0].{field}")


def to_long(number: Column) -> Column:
    """Whole part of a number given as text or number; NULL where there is none."""
    return number.try_cast("double").try_cast("bigint")


def to_int(number: Column) -> Column:
    """Whole part as a 32-bit integer; NULL where it is not a number or does not fit."""
    return number.try_cast("double").try_cast("int")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, NULL where ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
