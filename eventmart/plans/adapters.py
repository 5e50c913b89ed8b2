"""The star-schema test tables in the shapes this library works on.

``events`` becomes standard events, or raw vendor logs; ``lineitem``, ``orders`` and ``customer``
become a purchase mart that covers several years. Everything is projection and equi-joins, so the
filters and columns of a query still reach the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions import wall_clock
from eventmart.operators import standardize, union_events
from eventmart.schemas import RAW_FIELDS, VENDORS, raw_schema

_TIMES = ("logTimeStamp", "eventTimeStamp")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with the number ``k`` from its JSON properties."""
    return _table(spark, sf_dir, "events").selectExpr(
        "*", "CAST(get_json_object(props, '$.k') AS INT) AS k"
    )


def _by_os(android: str, ios: str, other: str) -> str:
    return (
        f"CASE WHEN user_id % 10 < 5 THEN '{android}' WHEN user_id % 10 < 9 THEN '{ios}' "
        f"ELSE '{other}' END"
    )


_SECOND = "timestampadd(SECOND, unix_timestamp(ts), TIMESTAMP_NTZ '1970-01-01 00:00:00')"

_STANDARD = {
    "tracking": "elt(CAST(event_id % 3 AS INT) + 1, 'ADBRIX', 'BRANCH', 'SINGULAR')",
    "trackingId": "concat('app_', user_id % 5)",
    "trackingEventCode": """
        CASE event_type WHEN 'view' THEN 'TPD002' WHEN 'click' THEN 'TPD003'
          WHEN 'purchase' THEN 'TPD004' WHEN 'signup' THEN 'TPD012'
          WHEN 'error' THEN elt(k % 3 + 1, 'TPD007', 'TPD008', 'TPD009') END""",
    "cid": "CAST(user_id AS STRING)",
    "osTypeCode": _by_os("ATC001", "ATC002", "ATC999"),
    "logTimeStamp": _SECOND,
    "eventTimeStamp": _SECOND,
    "eventDate": "CAST(ts AS DATE)",
    "eventHour": "lpad(CAST(hour(ts) AS STRING), 2, '0')",
    "campaign": "''",
    "contentId": "CAST(k AS STRING)",
    "contentName": "''",
    "value": "CAST(floor(value) AS INT)",
    "quantity": "k % 5 + 1",
    "amount": "CAST(floor(value) AS INT) * (k % 5 + 1)",
    "currency": "'KRW'",
    "activityParam": "props",
    "attributed": "''",
    "latdAdvertisingPartnerName": "''",
}


def standard_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as standard events, times without time zone."""
    return _keyed_events(spark, sf_dir).selectExpr(
        *(f"{expression} AS {name}" for name, expression in _STANDARD.items())
    )


def with_instants(events: DataFrame) -> DataFrame:
    """Times as instants, reading those without time zone as UTC, as the event table stores them."""
    return events.withColumns({c: F.timestamp_seconds(F.unix_timestamp(c)) for c in _TIMES})


def with_wall_clocks(events: DataFrame) -> DataFrame:
    """Times as UTC wall clocks, which look the same in every session."""
    return events.withColumns({c: wall_clock(F.col(c), "UTC") for c in _TIMES})


def purchase_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a purchase mart; large sides meet on their keys, without hints."""
    return (
        _table(spark, sf_dir, "lineitem")
        .join(_table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))
        .join(_table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .selectExpr(
            "c_mktsegment AS app_name",
            "CASE o_orderstatus WHEN 'F' THEN 'ATC001' WHEN 'O' THEN 'ATC002' ELSE 'ATC999' END "
            "AS os_typecode",
            "CAST(o_custkey AS STRING) AS c_id",
            "CAST(l_partkey AS STRING) AS content_id",
            "CAST(floor(l_quantity) AS BIGINT) AS quantity_total",
            "CAST(floor(l_extendedprice) AS BIGINT) AS amount_total",
            "CAST(o_orderdate AS DATE) AS event_date",
            "year(o_orderdate) AS event_year",
            "month(o_orderdate) AS event_month",
            "day(o_orderdate) AS event_day",
        )
    )


# --- raw vendor logs -------------------------------------------------------------------------------

_APP = "CASE WHEN k % 10 <> 9 THEN concat('app_', user_id % 5) END"  # one in ten names none
_GOOGLE_ID, _APPLE_ID = "concat('g-', user_id)", "concat('i-', user_id)"
_PRODUCT, _PRODUCT_NAME = "concat('p', k)", "concat('item ', k)"
_CAMPAIGN = "concat('c', k % 7)"
_CURRENCY = "if(k % 2 = 0, 'KRW', 'USD')"
_EPOCH_SECOND = "unix_timestamp(ts)"
_EPOCH_MILLI = (
    "unix_timestamp(ts) * 1000 + CAST(floor(extract(SECOND FROM ts) * 1000) AS BIGINT) % 1000"
)

_RAW = {
    "ADBRIX": {
        "package_name": _APP,
        "activity": """
            CASE event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart'
              WHEN 'purchase' THEN if(k % 4 = 3, 'refund', 'purchase') WHEN 'signup' THEN 'sign_up'
              WHEN 'error' THEN elt(k % 4 + 1, 'search', 'login', 'add_to_wishlist', 'crash') END""",
        "platform": _by_os("android", "ios", "web"),
        "gaid": _GOOGLE_ID,
        "ifa": _APPLE_ID,
        "event_time": _EPOCH_SECOND,
        "product_id": _PRODUCT,
        "product_name": _PRODUCT_NAME,
        "price": "CAST(value AS STRING)",
        "quantity": "k % 5 + 1",
        "sales": "value * (k % 5 + 1)",
        "currency": _CURRENCY,
        "activity_param": "props",
    },
    "BRANCH": {
        "organization_name": _APP,
        "name": """
            CASE event_type WHEN 'view' THEN 'VIEW_ITEM' WHEN 'click' THEN 'ADD_TO_CART'
              WHEN 'purchase' THEN 'PURCHASE' WHEN 'signup' THEN 'INSTALL'
              WHEN 'error' THEN elt(k % 3 + 1, 'SEARCH', 'OPEN', 'CRASH') END""",
        "ud_os": _by_os("ANDROID", "IOS", "WEB"),
        "ud_aaid": _GOOGLE_ID,
        "ud_idfa": _APPLE_ID,
        "event_timestamp": _EPOCH_MILLI,
        "latd_campaign": _CAMPAIGN,
        "ci0_product_name": _PRODUCT,
        "ci0_price": "CAST(value AS STRING)",
        "ci0_quantity": "CAST(k % 5 + 1 AS STRING)",
        "ci0_currency": _CURRENCY,
        "attributed": "if(user_id % 2 = 0, 'true', 'false')",
        "latd_advertising_partner_name": "concat('partner', user_id % 4)",
    },
    "SINGULAR": {
        "app_name": _APP,
        "evtname": """
            CASE event_type WHEN 'view' THEN 'ViewItem' WHEN 'click' THEN 'AddToCart'
              WHEN 'purchase' THEN elt(k % 3 + 1, 'Purchase', 'FirstPurchase', '__iap__')
              WHEN 'signup' THEN '__START__'
              WHEN 'error' THEN if(k % 2 = 0, '__SESSION__', 'Crash') END""",
        "platform": _by_os("Android", "iOS", "Web"),
        "aifa": _GOOGLE_ID,
        "idfa": _APPLE_ID,
        "utc": _EPOCH_SECOND,
        "cid": _CAMPAIGN,
        "evtattr": f"""
            to_json(array(named_struct('id', {_PRODUCT}, 'prd_code', concat('x', k),
              'product', {_PRODUCT_NAME}, 'price', value, 'quantity', k % 5 + 1)))""",
        "amount": "CAST(value * (k % 5 + 1) AS STRING)",
        "currency": _CURRENCY,
        "is_re_eng": "if(user_id % 2 = 0, '1', '0')",
    },
}


def _fields(vendor: str) -> str:
    return ", ".join(
        f"'{name}', nvl2({value}, array({value}), NULL)"
        for name, value in ((name, _RAW[vendor][name]) for name in RAW_FIELDS[vendor])
    )


def raw_lines(spark: SparkSession, sf_dir: str, vendor: str) -> DataFrame:
    """All of ``events`` as the JSON lines one vendor would deliver."""
    return _keyed_events(spark, sf_dir).selectExpr(f"""
        to_json(named_struct('logTimeStamp', {_EPOCH_MILLI} + 5999,
          'trackingObject', named_struct({_fields(vendor)}))) AS value""")


def faulty_lines(spark: SparkSession, sf_dir: str, vendor: str) -> DataFrame:
    """The same lines with faults: one in 50 is cut off, in another the currency is not in an array."""
    return _keyed_events(spark, sf_dir).selectExpr("event_id", f"""
        to_json(named_struct('logTimeStamp', {_EPOCH_MILLI}, 'trackingObject', named_struct({_fields(vendor)}))) AS line""").selectExpr(r"""
        CASE event_id % 50 WHEN 0 THEN left(line, 60)
          WHEN 1 THEN regexp_replace(line, 'currency":\\["([A-Z]+)"\\]', 'currency":"$1"') ELSE line END AS value""")


def raw_logs(spark: SparkSession, sf_dir: str, vendor: str) -> DataFrame:
    """The same lines parsed by the raw schema.

    The parsed struct goes through a generator, so that a line is parsed once; filters on a plain
    projection would be pushed below it and parse again.
    """
    parsed = F.from_json(
        "value", raw_schema(vendor), {"columnNameOfCorruptRecord": "_corrupt_record"}
    )
    return raw_lines(spark, sf_dir, vendor).select(F.inline(F.array(parsed)))


def standardized_logs(spark: SparkSession, sf_dir: str, tz: str = "UTC") -> DataFrame:
    """All vendors' lines through standardisation and union."""
    return union_events(
        spark, *(standardize(raw_logs(spark, sf_dir, v), v, tz) for v in VENDORS)
    )
