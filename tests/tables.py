"""Small hand-made tables."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from eventmart.schemas import EVENT_BY_USER, PURCHASE_BY_USER, TIER1, raw_schema

# Standard events with times that have no zone, so that tests read the same in any session.
EVENTS = T.StructType([
    T.StructField(f.name, T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType) else f.dataType)
    for f in TIER1
])


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows_of(frame: DataFrame, *columns: str) -> list[tuple]:
    """Rows as sorted tuples, None first."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, v) for v in r])


def events(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Standard events; ``when`` sets time, date and hour at once."""
    full = []
    for row in rows:
        when = at(row.pop("when", "2021-01-01 00:00:00"))
        base = {
            "tracking": "ADBRIX",
            "trackingId": "app",
            "trackingEventCode": "TPD004",
            "cid": "u1",
            "osTypeCode": "ATC001",
            "logTimeStamp": when,
            "eventTimeStamp": when,
            "eventDate": when.date(),
            "eventHour": f"{when:%H}",
            "campaign": "",
            "contentId": "p1",
            "contentName": "",
            "value": 1,
            "quantity": 1,
            "amount": 1,
            "currency": "KRW",
            "activityParam": "",
            "attributed": "",
            "latdAdvertisingPartnerName": "",
        } | row
        full.append(tuple(base[f.name] for f in EVENTS))
    return spark.createDataFrame(full, EVENTS)


def _mart(spark, rows, schema, base) -> DataFrame:
    full = []
    for row in rows:
        merged = base | row
        date = day(merged["event_date"])
        merged |= {
            "event_date": date,
            "event_year": date.year,
            "event_month": date.month,
            "event_day": date.day,
        }
        full.append(tuple(merged[f.name] for f in schema))
    return spark.createDataFrame(full, schema)


def user_mart(spark: SparkSession, rows: list[dict]) -> DataFrame:
    base = {
        "app_name": "app",
        "c_id": "u1",
        "os_typecode": "ATC001",
        "event_count": 1,
        "event_typecode": "TPD002",
        "event_date": "2021-01-01",
        "event_hour": "00",
    }
    return _mart(spark, rows, EVENT_BY_USER, base)


def purchase_mart(spark: SparkSession, rows: list[dict]) -> DataFrame:
    base = {
        "app_name": "app",
        "os_typecode": "ATC001",
        "c_id": "u1",
        "content_id": "p1",
        "quantity_total": 1,
        "amount_total": 1,
        "event_date": "2021-01-01",
    }
    return _mart(spark, rows, PURCHASE_BY_USER, base)


RAW_ROWS = {
    "ADBRIX": {
        "package_name": ["shop.a"], "activity": ["purchase"], "platform": ["android"],
        "gaid": ["g-1"], "ifa": ["i-1"], "event_time": [1609459200], "product_id": ["p1"],
        "product_name": ["Mug"], "price": ["10.5"], "quantity": [2], "sales": [21],
        "currency": ["KRW"], "activity_param": ["{}"],
    },
    "BRANCH": {
        "organization_name": ["shop-b"], "name": ["ADD_TO_CART"], "ud_os": ["IOS"],
        "ud_aaid": ["g-2"], "ud_idfa": ["i-2"], "event_timestamp": [1609459200999],
        "latd_campaign": ["c1"], "ci0_product_name": ["Hat"], "ci0_price": ["10.5"],
        "ci0_quantity": ["2"], "ci0_currency": ["KRW"], "attributed": ["true"],
    },
    "SINGULAR": {
        "app_name": ["shop-c"], "evtname": ["__iap__"], "platform": ["iOS"], "aifa": ["g-3"],
        "idfa": ["i-3"], "utc": [1609459200], "cid": ["c2"],
        "evtattr": ['[{"id":"p9","prd_code":"x","product":"Pen","price":7,"quantity":3}]'],
        "amount": ["21"], "currency": ["KRW"], "is_re_eng": ["0"],
    },
}


def raw_line(vendor: str, log_time: object = 1609459205999, **changes: object) -> str:
    """One JSON log line; a field set to None is left out."""
    tracked = {k: v for k, v in (RAW_ROWS[vendor] | changes).items() if v is not None}
    return json.dumps({"logTimeStamp": log_time, "trackingObject": tracked})


def write_lines(path, lines: list[str]) -> None:
    path.mkdir(parents=True, exist_ok=True)
    (path / "part.json").write_text("\n".join(lines) + "\n")


def raw_frame(spark: SparkSession, folder, vendor: str, lines: list[str]) -> DataFrame:
    write_lines(folder, lines)
    return (
        spark.read.schema(raw_schema(vendor))
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(str(folder))
    )
