"""Table shapes and code dictionaries.

Everything here is a fixed value: the names, codes and formats are the data contract between the
attribution vendors, the stored tables and the reports, so they have to be exactly these.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: vendors -------------------------------------------------------------------

VENDORS = ("ADBRIX", "BRANCH", "SINGULAR")

# Fields of ``trackingObject``. Each holds an array of which element 0 counts.
RAW_FIELDS = {
    "ADBRIX": (
        "package_name", "activity", "platform", "gaid", "ifa", "event_time", "product_id",
        "product_name", "price", "quantity", "sales", "currency", "activity_param",
    ),
    "BRANCH": (
        "organization_name", "name", "ud_os", "ud_aaid", "ud_idfa", "event_timestamp",
        "latd_campaign", "ci0_product_name", "ci0_price", "ci0_quantity", "ci0_currency",
        "attributed", "latd_advertising_partner_name",
    ),
    "SINGULAR": (
        "app_name", "evtname", "platform", "aifa", "idfa", "utc", "cid", "evtattr", "amount",
        "currency", "is_re_eng",
    ),
}

# Raw folder of a vendor's day below the raw root, and the day inside such a path.
RAW_FOLDER = "thirdparty-{vendor}/{day:%Y-%m/%d}"
RAW_DAY_IN_PATH = r"/thirdparty-[^/]+/(\d{4}-\d{2})/(\d{2})/"

# --- fixed values: event, platform and application codes --------------------------------------

SEARCH = "TPD001"
VIEW = "TPD002"
CART = "TPD003"
PURCHASE = "TPD004"
SEARCH_ALT = "TPD007"
INSTALL = "TPD008"
OPEN = "TPD009"
FIRST_PURCHASE = "TPD010"
IN_APP_PURCHASE = "TPD011"
SIGN_UP = "TPD012"
LOGIN = "TPD013"
WISHLIST = "TPD014"
REFUND = "TPD015"
CART_ALT = "TPD016"
OTHER_EVENT = "TPD999"

EVENT_CODES = {
    "ADBRIX": {
        "search": SEARCH,
        "product_view": VIEW,
        "add_to_cart": CART,
        "purchase": PURCHASE,
        "sign_up": SIGN_UP,
        "login": LOGIN,
        "add_to_wishlist": WISHLIST,
        "refund": REFUND,
    },
    "BRANCH": {
        "VIEW_ITEM": VIEW,
        "ADD_TO_CART": CART,
        "PURCHASE": PURCHASE,
        "SEARCH": SEARCH_ALT,
        "INSTALL": INSTALL,
        "OPEN": OPEN,
    },
    "SINGULAR": {
        "ViewItem": VIEW,
        "AddToCart": CART,
        "Purchase": PURCHASE,
        "__START__": INSTALL,
        "__SESSION__": OPEN,
        "FirstPurchase": FIRST_PURCHASE,
        "__iap__": IN_APP_PURCHASE,
    },
}

# The one event of SINGULAR whose JSON attributes carry id, price and quantity.
SINGULAR_IN_APP = "__iap__"

ANDROID = "ATC001"
IOS = "ATC002"
OTHER_OS = "ATC999"

OS_CODES = {
    "ADBRIX": {"android": ANDROID, "ios": IOS},
    "BRANCH": {"ANDROID": ANDROID, "IOS": IOS},
    "SINGULAR": {"Android": ANDROID, "iOS": IOS},
}

# Applications left out of the user mart, and applications that sell by in-app purchase.
EXCLUDED_APPS = ("HNS_DEV",)
PURCHASE_CODE_BY_APP = {"홈&쇼핑": IN_APP_PURCHASE, "hnsmall11": IN_APP_PURCHASE}

# Advertising id sent by devices on which tracking is switched off.
ZERO_ID = "00000000-0000-0000-0000-000000000000"

# --- table shapes ------------------------------------------------------------------------------


def raw_schema(vendor: str) -> T.StructType:
    """Raw log of one vendor; every leaf is text because vendors mix numbers and strings."""
    texts = T.ArrayType(T.StringType())
    return T.StructType([
        T.StructField("logTimeStamp", T.StringType()),
        T.StructField(
            "trackingObject",
            T.StructType([T.StructField(name, texts) for name in RAW_FIELDS[vendor]]),
        ),
        T.StructField("_corrupt_record", T.StringType()),
    ])


TIER1 = T.StructType([
    T.StructField("tracking", T.StringType()),
    T.StructField("trackingId", T.StringType()),
    T.StructField("trackingEventCode", T.StringType()),
    T.StructField("cid", T.StringType()),
    T.StructField("osTypeCode", T.StringType()),
    T.StructField("logTimeStamp", T.TimestampType()),
    T.StructField("eventTimeStamp", T.TimestampType()),
    T.StructField("eventDate", T.DateType()),
    T.StructField("eventHour", T.StringType()),
    T.StructField("campaign", T.StringType()),
    T.StructField("contentId", T.StringType()),
    T.StructField("contentName", T.StringType()),
    T.StructField("value", T.IntegerType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("amount", T.IntegerType()),
    T.StructField("currency", T.StringType()),
    T.StructField("activityParam", T.StringType()),
    T.StructField("attributed", T.StringType()),
    T.StructField("latdAdvertisingPartnerName", T.StringType()),
])

TIER1_STORED = T.StructType([
    *TIER1.fields,
    T.StructField("hour", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("run_date", T.DateType()),
])

RAW_QUALITY = T.StructType([
    T.StructField("tracking", T.StringType()),
    T.StructField("lines", T.LongType()),
    T.StructField("events", T.LongType()),
    T.StructField("unreadable", T.LongType()),
    T.StructField("no_app", T.LongType()),
    T.StructField("partly_read", T.LongType()),
    T.StructField("run_date", T.DateType()),
])

EVENT_BY_USER = T.StructType([
    T.StructField("app_name", T.StringType()),
    T.StructField("c_id", T.StringType()),
    T.StructField("os_typecode", T.StringType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("event_typecode", T.StringType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("event_year", T.IntegerType()),
    T.StructField("event_month", T.IntegerType()),
    T.StructField("event_day", T.IntegerType()),
    T.StructField("event_hour", T.StringType()),
])

PURCHASE_BY_USER = T.StructType([
    T.StructField("app_name", T.StringType()),
    T.StructField("os_typecode", T.StringType()),
    T.StructField("c_id", T.StringType()),
    T.StructField("content_id", T.StringType()),
    T.StructField("quantity_total", T.LongType()),
    T.StructField("amount_total", T.LongType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("event_year", T.IntegerType()),
    T.StructField("event_month", T.IntegerType()),
    T.StructField("event_day", T.IntegerType()),
])


def stored(mart: T.StructType) -> T.StructType:
    """A mart as it lies on disk: its columns and the partition column ``date``."""
    return T.StructType([*mart.fields, T.StructField("date", T.DateType())])
