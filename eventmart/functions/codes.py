"""Vendor vocabulary to common codes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventmart.schemas import EVENT_CODES, OS_CODES, OTHER_EVENT, OTHER_OS


def _translate(source: Column, codes: dict[str, str], default: str) -> Column:
    code_of = F.lit(default)
    for name, code in codes.items():
        code_of = F.when(source == name, code).otherwise(code_of)
    return code_of


def event_code(vendor: str, name: Column) -> Column:
    """Common event code of a vendor's event name; unknown and NULL names become the catch-all code."""
    return _translate(name, EVENT_CODES[vendor], OTHER_EVENT)


def os_code(vendor: str, platform: Column) -> Column:
    """Common platform code; the spelling is vendor specific and case-sensitive."""
    return _translate(platform, OS_CODES[vendor], OTHER_OS)


def device_id(vendor: str, field: Callable[[str], Column]) -> Column:
    """Advertising id for the device's platform; ``field`` gives a vendor field by name.

    Two vendors fall back to the Apple id on every platform but Android; BRANCH has no fallback.
    """
    if vendor == "BRANCH":
        return F.when(field("ud_os") == "ANDROID", field("ud_aaid")).when(
            field("ud_os") == "IOS", field("ud_idfa")
        )
    android, google_id, apple_id = {
        "ADBRIX": ("android", "gaid", "ifa"),
        "SINGULAR": ("Android", "aifa", "idfa"),
    }[vendor]
    return F.when(field("platform") == android, field(google_id)).otherwise(field(apple_id))
