"""User dimension: totals, most common attributes, segment and life-cycle stage."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.functions import columns as C
from clickmill.operators.facets import facets
from clickmill.operators.kpis import is_type, total
from clickmill.schemas import DIM_USERS

EVENT_COUNTS = {
    "page_views": "page_view",
    "clicks": "click",
    "cart_additions": "add_to_cart",
    "purchases": "purchase",
    "cashback_events": "cashback_earned",
    "refunds": "refund",
}
DISTINCTS = {
    "active_days": "event_date",
    "total_sessions": "session_id",
    "unique_products_viewed": "product_id",
}
MODES = {
    "primary_device": "device_type",
    "primary_browser": "browser",
    "country": "country",
    "city": "city",
}


def user_sums(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(
        F.min("event_date").alias("first_seen_date"),
        F.max("event_date").alias("last_seen_date"),
        F.count(F.lit(1)).alias("total_events"),
        *[F.count_if(is_type(t)).alias(name) for name, t in EVENT_COUNTS.items()],
        total(F.col("revenue"), "purchase").alias("total_revenue"),
        total(F.col("cashback_amount"), "cashback_earned").alias("total_cashback"),
    )


def user_values(events: DataFrame, columns: list[str]) -> DataFrame:
    """Events per user, column and value."""
    return facets(
        events.select("user_id", *columns), ["user_id"], columns, F.count(F.lit(1)).alias("n")
    )


def _mode(column: str):
    """Most frequent value, the smallest of equally frequent ones; nulls do not take part."""
    rank = F.struct((-F.col("n")).alias("n"), F.col("value"))
    return F.min(F.when(F.col("facet") == column, rank))["value"]


def user_modes(events: DataFrame) -> DataFrame:
    """Most common device, browser, country and city per user, by counting in the shuffle."""
    return user_values(events, list(MODES.values())).groupBy("user_id").agg(*user_modes_of())


def user_modes_of() -> list[Column]:
    """The aggregates over `facet`, `value`, `n` that give the most common values."""
    return [_mode(column).alias(name) for name, column in MODES.items()]


def user_profile(events: DataFrame) -> DataFrame:
    """Distinct counts and modes per user from one pass over the long form of seven columns."""
    return user_values(events, [*DISTINCTS.values(), *MODES.values()]).groupBy("user_id").agg(
        *[F.count_if(F.col("facet") == c).alias(name) for name, c in DISTINCTS.items()],
        *user_modes_of(),
    )


def dim_users(stg: DataFrame, as_of: date | str) -> DataFrame:
    totals = user_sums(stg).join(user_profile(stg), "user_id", "left").fillna(0, list(DISTINCTS))
    return with_ages(totals, as_of)


def with_ages(totals: DataFrame, as_of: date | str) -> DataFrame:
    """Ages, ratios, segment and stage of the users' totals, row by row."""
    today = C.day(as_of)
    return (
        totals.withColumns(
            {
                "account_age_days": C.days_between("first_seen_date", today),
                "days_since_last_active": C.days_between("last_seen_date", today),
                "conversion_rate": C.percentage("purchases", "page_views"),
                "avg_order_value": C.safe_divide("total_revenue", "purchases"),
            }
        )
        .withColumns(
            {
                "user_segment": C.user_segment(
                    "purchases", "active_days", "page_views", "days_since_last_active"
                ),
                "lifecycle_stage": C.lifecycle_stage("account_age_days", "days_since_last_active"),
            }
        )
        .select(DIM_USERS.fieldNames())
    )
