"""Daily key figures."""

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.functions import columns as C
from clickmill.operators.activity import rolling_active_users, user_days
from clickmill.operators.facets import facets
from clickmill.schemas import DAILY_KPIS, DEVICES

EVENT_COUNTS = {
    "page_views": "page_view",
    "clicks": "click",
    "add_to_carts": "add_to_cart",
    "purchases": "purchase",
    "cashback_events": "cashback_earned",
    "refunds": "refund",
}


def is_type(event_type: str) -> Column:
    return F.col("event_type") == event_type


def total(amount: Column, event_type: str) -> Column:
    """Sum over the events of one type, 0 if there are none."""
    zero = F.lit(0).cast("decimal(22,2)")
    return F.coalesce(F.sum(F.when(is_type(event_type), amount)), zero).cast("decimal(22,2)")


def daily_sums(fact: DataFrame) -> DataFrame:
    """Counts and sums per day; all of it is combined before the shuffle."""
    return fact.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("total_events"),
        *[F.count_if(is_type(t)).alias(name) for name, t in EVENT_COUNTS.items()],
        total(F.col("revenue"), "purchase").alias("daily_revenue"),
        total(F.col("cashback_amount"), "cashback_earned").alias("daily_cashback"),
        total(F.abs("revenue"), "refund").alias("daily_refunds"),
    )


def daily_distincts(fact: DataFrame) -> DataFrame:
    """Users, buyers, users per device, sessions and products sold per day."""
    devices = [F.coalesce(F.col("device_type") == d, F.lit(False)).alias(d) for d in DEVICES]
    bought = F.coalesce(is_type("purchase"), F.lit(False))
    sold = F.when(bought, F.col("product_id")).alias("product_id")  # others need no shuffle
    seen = facets(
        fact.select("event_date", "user_id", "session_id", sold, bought.alias("bought"), *devices),
        ["event_date"],
        ["user_id", "session_id", "product_id"],
        *[F.max(c).alias(c) for c in ("bought", *DEVICES)],
    )
    user = F.col("facet") == "user_id"
    return seen.groupBy("event_date").agg(
        F.count_if(user).alias("dau"),
        F.count_if(F.col("facet") == "session_id").alias("daily_sessions"),
        F.count_if(user & F.col("bought")).alias("purchasing_users"),
        F.count_if(F.col("facet") == "product_id").alias("products_sold"),
        *[F.count_if(user & F.col(d)).alias(f"{d}_users") for d in DEVICES],
    )


def weekly_reach(days: Iterable[date], step: int) -> list[date]:
    """The days and the six after (`step` 1) or before (-1) each."""
    return sorted({d + timedelta(days=step * k) for d in days for k in range(7)})


def daily_kpis(
    fact: DataFrame, since: str | None = None, days: Sequence[date] | None = None
) -> DataFrame:
    """One row per day with events, from `since` on or of `days` if given.

    Weekly users look back over the fact, of which only the six days before each one can count.
    """
    if days is not None:  # calendar days in a checked range
        recent = fact.where(F.col("event_date").isin(list(days)))
        near = fact.where(F.col("event_date").isin(weekly_reach(days, -1)))
        weekly = rolling_active_users(user_days(near))
    else:
        recent = fact.where(F.col("event_date") >= C.day(since)) if since else fact
        weekly = rolling_active_users(user_days(fact), since=since)
    joined = (
        daily_sums(recent)
        .join(daily_distincts(recent), "event_date", "left")
        .join(weekly, "event_date", "left")
        .fillna(0)
    )
    return kpi_ratios(joined).select(DAILY_KPIS.fieldNames())


def kpi_ratios(daily: DataFrame) -> DataFrame:
    """Conversion, order value and revenue per user from a day's counts and sums."""
    return daily.withColumns(
        {
            "conversion_rate": C.percentage("purchases", "page_views", places=4),
            "avg_order_value": C.safe_divide("daily_revenue", "purchases"),
            "revenue_per_user": C.safe_divide("daily_revenue", "dau"),
        }
    )
