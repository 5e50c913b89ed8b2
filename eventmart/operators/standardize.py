"""Raw vendor logs to the common 19-column event table.

All of it is projection, filter and union: no shuffle, and any number of scan tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions import (
    device_id,
    epoch_cols,
    event_code,
    first_item,
    json_item,
    local_hour,
    os_code,
    to_int,
)
from eventmart.schemas import SINGULAR_IN_APP, TIER1

# Per vendor: application, event name, platform, event time and the unit of the event time.
_IDENTITY = {
    "ADBRIX": ("package_name", "activity", "platform", "event_time", "s"),
    "BRANCH": ("organization_name", "name", "ud_os", "event_timestamp", "ms"),
    "SINGULAR": ("app_name", "evtname", "platform", "utc", "s"),
}


def field(name: str) -> Column:
    """Value of a vendor field: element 0 of its array."""
    return first_item(F.col(f"trackingObject.{name}"))


def _adbrix() -> dict[str, Column]:
    return {
        "contentId": field("product_id"),
        "contentName": field("product_name"),
        "value": to_int(field("price")),
        "quantity": to_int(field("quantity")),
        "amount": to_int(field("sales")),
        "currency": field("currency"),
        "activityParam": field("activity_param"),
    }


def _branch() -> dict[str, Column]:
    price, quantity = field("ci0_price"), field("ci0_quantity")
    return {
        "campaign": field("latd_campaign"),
        "contentId": field("ci0_product_name"),
        "value": to_int(price),
        "quantity": to_int(quantity),
        "amount": to_int(price.try_cast("double") * quantity.try_cast("double")),
        "currency": field("ci0_currency"),
        "attributed": field("attributed"),
        "latdAdvertisingPartnerName": field("latd_advertising_partner_name"),
    }


def _singular() -> dict[str, Column]:
    attributes = field("evtattr")
    in_app = field("evtname") == SINGULAR_IN_APP

    def only_in_app(name: str) -> Column:
        return F.when(in_app, to_int(json_item(attributes, name))).otherwise(0)

    return {
        "campaign": field("cid"),
        "contentId": F.when(in_app, json_item(attributes, "id")).otherwise(
            json_item(attributes, "prd_code")
        ),
        "contentName": json_item(attributes, "product"),
        "value": only_in_app("price"),
        "quantity": only_in_app("quantity"),
        "amount": to_int(field("amount")),
        "currency": field("currency"),
        "activityParam": attributes,
        "attributed": field("is_re_eng"),
    }


_DETAILS = {"ADBRIX": _adbrix, "BRANCH": _branch, "SINGULAR": _singular}


def standardize(raw: DataFrame, vendor: str, tz: str = "UTC") -> DataFrame:
    """One vendor's raw log as standard events; dates and hours are local to ``tz``.

    A column the vendor has no field for is the empty text. Columns of ``raw`` other than the log
    itself (such as its run date) are passed through behind the 19.
    """
    app, name, platform, event_time, unit = _IDENTITY[vendor]
    log_time, _, _ = epoch_cols(F.col("logTimeStamp"), "ms", tz)
    event_moment, event_date, event_hour = epoch_cols(field(event_time), unit, tz)
    columns = {
        "tracking": F.lit(vendor),
        "trackingId": field(app),
        "trackingEventCode": event_code(vendor, field(name)),
        "cid": device_id(vendor, field),
        "osTypeCode": os_code(vendor, field(platform)),
        "logTimeStamp": log_time,
        "eventTimeStamp": event_moment,
        "eventDate": event_date,
        "eventHour": event_hour,
    } | _DETAILS[vendor]()
    log_columns = {"logTimeStamp", "trackingObject", "_corrupt_record"}
    return raw.select(
        *(
            columns.get(target.name, F.lit("")).cast(target.dataType).alias(target.name)
            for target in TIER1
        ),
        *(F.col(extra) for extra in raw.columns if extra not in log_columns),
    )


def empty_events(spark: SparkSession) -> DataFrame:
    """The event table without rows."""
    return spark.createDataFrame([], TIER1)


def union_events(spark: SparkSession, *events: DataFrame) -> DataFrame:
    """All vendors' events that name an application; typed and empty if there is no vendor."""
    everything = reduce(DataFrame.unionByName, events) if events else empty_events(spark)
    return everything.where(F.col("trackingId").isNotNull())


def with_partition_columns(events: DataFrame) -> DataFrame:
    """Copies of event date and hour, so that the data columns survive partitioning by ``date``."""
    return events.withColumns({"date": F.col("eventDate"), "hour": F.col("eventHour")})


def with_process_time(events: DataFrame, moment: Column | None = None, tz: str = "UTC") -> DataFrame:
    """When the events were processed: ``processDate``, an instant, and ``processHour``, its hour in ``tz``."""
    moment = F.current_timestamp() if moment is None else moment
    hour = local_hour(moment, tz).cast("int")
    return events.withColumns({"processDate": moment, "processHour": hour})


#: What may be wrong with a raw line: it does not fit the schema and names no application, it fits but names none, or it names
#: one but not all of its fields could be read.
FAULTS = ("unreadable", "no_app", "partly_read")


def with_faults(raw: DataFrame, vendor: str) -> DataFrame:
    """Raw lines with ``fault``, NULL for a line without one, and then their text as ``line``.

    Standardising passes both columns on. The text of a line that fits the schema is written anew from what was read.
    """
    nameless, unfit = field(_IDENTITY[vendor][0]).isNull(), F.col("_corrupt_record").isNotNull()
    unreadable, no_app, partly_read = FAULTS
    fault = F.when(nameless, F.when(unfit, unreadable).otherwise(no_app)).when(unfit, partly_read)
    text = F.coalesce("_corrupt_record", F.to_json(F.struct("logTimeStamp", "trackingObject")))
    return raw.withColumns({"fault": fault, "line": F.when(fault.isNotNull(), text)})


def raw_quality(raw: DataFrame, vendor: str) -> DataFrame:
    """One row: raw lines, lines that did not fit the schema, lines that name no application."""
    app = _IDENTITY[vendor][0]
    return raw.agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count_if(F.col("_corrupt_record").isNotNull()).alias("corrupt_count"),
        F.count_if(field(app).isNull()).alias("no_app_count"),
    ).select(F.lit(vendor).alias("tracking"), "*")
