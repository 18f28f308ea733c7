"""Column contracts of every layer."""

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

# The event vocabulary, its lookup table, the funnel and the retention windows.
EVENT_TYPES = ["page_view", "click", "add_to_cart", "purchase", "cashback_earned", "refund"]
EVENT_TYPE_ROWS = [
    # event_type, description, is_revenue_event, funnel_order
    ("page_view", "User viewed a page on the platform", False, 1),
    ("click", "User clicked on a product or link", False, 2),
    ("add_to_cart", "User added an item to their shopping cart", False, 3),
    ("purchase", "User completed a purchase transaction", True, 4),
    ("cashback_earned", "User received cashback reward for a purchase", False, 5),
    ("refund", "User requested and received a refund", True, 6),
]
FUNNEL_STAGES = ["page_view", "click", "add_to_cart", "purchase", "cashback_earned"]
RETENTION_DAYS = [0, 1, 3, 7, 14, 30]
RETENTION_WEEKS = {1: (1, 7), 2: (8, 14), 3: (15, 21), 4: (22, 28)}
TIMES_OF_DAY = ["morning", "lunch", "afternoon", "evening", "night"]
USER_SEGMENTS = ["power_user", "regular", "casual_buyer", "window_shopper", "churned", "new_user"]
LIFECYCLE_STAGES = ["new", "active", "at_risk", "dormant"]
DEVICES = ["mobile", "desktop", "tablet"]
UNKNOWN = "unknown"
MIN_EVENT_DATE = "2020-01-01"
OTHER_DAY = "other"  # partition of rows whose date lies outside the accepted range
LOOKBACK_DAYS = 3
# Text cells a CSV reader following the pandas defaults takes as missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_TEXT, _LONG, _INT, _RATE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_FLAG, _DATE, _TIME = T.BooleanType(), T.DateType(), T.TimestampNTZType()
# A sum of DECIMAL(12,2) keeps Spark's wider sum type: twelve digits overflow on large tables.
_TOTAL = T.DecimalType(22, 2)

_EVENT_FIELDS = [
    ("event_id", _TEXT), ("user_id", _TEXT), ("event_type", _TEXT), ("event_timestamp", _TIME),
    ("event_date", _DATE), ("page_url", _TEXT), ("product_id", _TEXT), ("product_name", _TEXT),
    ("product_category", _TEXT), ("product_price", MONEY), ("quantity", _INT), ("revenue", MONEY),
    ("cashback_amount", MONEY), ("device_type", _TEXT), ("browser", _TEXT), ("country", _TEXT),
    ("city", _TEXT), ("session_id", _TEXT), ("referrer", _TEXT),
]
_WITH_HOUR = _EVENT_FIELDS[:5] + [("event_hour", _INT)] + _EVENT_FIELDS[5:]

RAW = _struct((name, _TEXT) for name, _ in _EVENT_FIELDS)
BRONZE = _struct(
    _EVENT_FIELDS + [("ingested_at", _TIME), ("source_file", _TEXT), ("batch_id", _TEXT)]
)
# The written bronze table: all rows, the file they belong to, and why a row is turned away.
BRONZE_ROWS = T.StructType(
    [*BRONZE.fields, T.StructField("source_path", _TEXT), T.StructField("reject_reason", _TEXT)]
)
# As it lies on disk: each load is a folder of its own, and within it rows lie by checked day.
BRONZE_TABLE = T.StructType(
    [*BRONZE_ROWS.fields, T.StructField("load_id", _INT), T.StructField("event_day", _TEXT)]
)
# One row per loaded file and load; its rows are what makes a load count.
BRONZE_FILES = _struct([("source_path", _TEXT), ("load_id", _INT)])
SILVER = _struct(
    _WITH_HOUR + [("is_valid", _FLAG), ("quality_flags", _TEXT), ("cleaned_at", _TIME)]
)
SILVER_TABLE = T.StructType([*SILVER.fields, T.StructField("event_day", _TEXT)])
FACT = _struct(
    _WITH_HOUR
    + [
        ("day_of_week", _INT), ("event_month", _INT), ("event_year", _INT),
        ("is_weekend", _FLAG), ("time_of_day", _TEXT),
        ("is_revenue_event", _FLAG), ("is_cashback_event", _FLAG),
    ]
)
DIM_USERS = _struct(
    [("user_id", _TEXT), ("first_seen_date", _DATE), ("last_seen_date", _DATE)]
    + [(c, _LONG) for c in (
        "active_days", "total_events", "page_views", "clicks", "cart_additions", "purchases",
        "cashback_events", "refunds")]
    + [("total_revenue", _TOTAL), ("total_cashback", _TOTAL),
       ("total_sessions", _LONG), ("unique_products_viewed", _LONG),
       ("primary_device", _TEXT), ("primary_browser", _TEXT), ("country", _TEXT), ("city", _TEXT),
       ("account_age_days", _INT), ("days_since_last_active", _INT),
       ("conversion_rate", _RATE), ("avg_order_value", _RATE),
       ("user_segment", _TEXT), ("lifecycle_stage", _TEXT)]
)
DAILY_KPIS = _struct(
    [("event_date", _DATE)]
    + [(c, _LONG) for c in (
        "dau", "daily_sessions", "total_events", "page_views", "clicks", "add_to_carts",
        "purchases", "cashback_events", "refunds")]
    + [("daily_revenue", _TOTAL), ("daily_cashback", _TOTAL), ("daily_refunds", _TOTAL)]
    + [(c, _LONG) for c in (
        "purchasing_users", "products_sold", "mobile_users", "desktop_users", "tablet_users")]
    + [("conversion_rate", _RATE), ("avg_order_value", _RATE), ("revenue_per_user", _RATE),
       ("wau", _LONG)]
)
FUNNEL = _struct([
    ("stage_order", _INT), ("stage_name", _TEXT), ("unique_users", _LONG), ("total_events", _LONG),
    ("overall_conversion_rate", _RATE), ("step_conversion_rate", _RATE),
    ("dropoff_count", _LONG), ("dropoff_rate", _RATE),
])
RETENTION = _struct(
    [("cohort_week", _DATE), ("cohort_size", _LONG)]
    + [(f"retained_day_{d}", _LONG) for d in RETENTION_DAYS if d]
    + [(f"retention_rate_day_{d}", _RATE) for d in RETENTION_DAYS if d]
    + [(f"retention_rate_week_{w}", _RATE) for w in RETENTION_WEEKS]
)
