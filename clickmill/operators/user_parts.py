"""Partial figures per user and day, which all figures by user or by day can be merged from.

Two tables keep what events add up to: `user_days`, one row per user and active day with counts and sums, and
`user_values`, how often a user had each value of a column on a day. Both are kept by day, so that a load
rebuilds the days it touches and nothing else; merging never reads an event again.
"""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.operators.activity import rolling_active_users
from clickmill.operators.facets import facets
from clickmill.operators.funnel import funnel_rates
from clickmill.operators.kpis import is_type, kpi_ratios, total, weekly_reach
from clickmill.operators.users import DISTINCTS, EVENT_COUNTS, MODES, user_modes_of, with_ages
from clickmill.schemas import DAILY_KPIS, DEVICES, FUNNEL_STAGES

KEYS = ["event_date", "user_id"]
COUNTS = ["total_events", *EVENT_COUNTS, *(f"{d}_events" for d in DEVICES)]
SUMS = ["total_revenue", "total_cashback", "total_refunds"]
VALUES = ["session_id", "product_id", *MODES.values(), "sold_product"]


def user_days(fact: DataFrame) -> DataFrame:
    """One row per day and user with events; combined before the shuffle."""
    return fact.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("total_events"),
        *[F.count_if(is_type(t)).alias(name) for name, t in EVENT_COUNTS.items()],
        *[F.count_if(F.col("device_type") == d).alias(f"{d}_events") for d in DEVICES],
        total(F.col("revenue"), "purchase").alias("total_revenue"),
        total(F.col("cashback_amount"), "cashback_earned").alias("total_cashback"),
        total(F.abs("revenue"), "refund").alias("total_refunds"),
    )


def user_values(fact: DataFrame) -> DataFrame:
    """`event_date`, `user_id`, `facet`, `value`, `n`; `sold_product` holds the products of purchases."""
    sold = F.when(is_type("purchase"), F.col("product_id")).alias("sold_product")
    return facets(fact.select(*KEYS, *VALUES[:-1], sold), KEYS, VALUES, F.count(F.lit(1)).alias("n"))


def _total(name: str):
    return F.sum(name).cast("decimal(22,2)" if name in SUMS else "long").alias(name)


def user_totals(days: DataFrame, values: DataFrame) -> DataFrame:
    """All of a user's figures that do not depend on the day they are looked at."""
    sums = days.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.min("event_date").alias("first_seen_date"),
        F.max("event_date").alias("last_seen_date"),
        F.count("event_date").alias("active_days"),
        *[_total(name) for name in (*COUNTS, *SUMS)],
    )
    merged = values.where("facet <> 'sold_product'").groupBy("user_id", "facet", "value").agg(F.sum("n").alias("n"))
    distincts = {name: c for name, c in DISTINCTS.items() if c != "event_date"}
    profile = merged.groupBy("user_id").agg(
        *[F.count_if(F.col("facet") == c).alias(name) for name, c in distincts.items()], *user_modes_of()
    )
    return sums.join(profile, "user_id", "left").fillna(0, list(distincts))


def of_users(parts: DataFrame, users: DataFrame) -> DataFrame:
    return parts.join(users, "user_id", "left_semi")


def dim_users(totals: DataFrame, as_of: date | str) -> DataFrame:
    """The user dimension: ages, segment and stage of stored totals, row by row."""
    return with_ages(totals, as_of)


def funnel_analysis(totals: DataFrame) -> DataFrame:
    """The conversion funnel: users that have a stage's event, and its events, from one row per user."""
    of = {t: name for name, t in EVENT_COUNTS.items() if t in FUNNEL_STAGES}
    stages = F.array(*[F.struct(F.lit(t).alias("event_type"), F.col(name).alias("n")) for t, name in of.items()])
    counts = totals.select(F.inline(stages)).groupBy("event_type").agg(
        F.count_if(F.col("n") > 0).alias("unique_users"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_events")
    )
    return funnel_rates(counts)


def daily_kpis(days: DataFrame, values: DataFrame, only: list[date] | None = None) -> DataFrame:
    """The daily figures, of the days `only` if given: the fact is not read.

    Sessions and sold products are distinct over users, so they are counted by value.
    """
    recent, near, seen = days, days, values
    if only is not None:
        recent = days.where(F.col("event_date").isin(only))
        near = days.where(F.col("event_date").isin(weekly_reach(only, -1)))
        seen = values.where(F.col("event_date").isin(only))
    renamed = {"cart_additions": "add_to_carts", "total_revenue": "daily_revenue", "total_cashback": "daily_cashback"}
    kept = ["total_events", *EVENT_COUNTS, "total_revenue", "total_cashback"]
    user = F.col("user_id").isNotNull()
    sums = recent.groupBy("event_date").agg(
        *[_total(name).alias(renamed.get(name, name)) for name in kept],
        _total("total_refunds").alias("daily_refunds"),
        F.count("user_id").alias("dau"),
        F.count_if(user & (F.col("purchases") > 0)).alias("purchasing_users"),
        *[F.count_if(user & (F.col(f"{d}_events") > 0)).alias(f"{d}_users") for d in DEVICES],
    )
    distinct = (
        seen.where(F.col("facet").isin("session_id", "sold_product"))
        .groupBy("event_date", "facet", "value").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("event_date").agg(
            F.count_if(F.col("facet") == "session_id").alias("daily_sessions"),
            F.count_if(F.col("facet") == "sold_product").alias("products_sold"),
        )
    )
    weekly = rolling_active_users(near.select("user_id", "event_date"))
    joined = sums.join(distinct, "event_date", "left").join(weekly, "event_date", "left").fillna(0)
    return kpi_ratios(joined).select(DAILY_KPIS.fieldNames())
