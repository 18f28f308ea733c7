import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertSchemaEqual

from clickmill.operators import activity, facts, funnel, kpis, retention, users
from clickmill.schemas import DAILY_KPIS, DIM_USERS, FACT, FUNNEL, RETENTION, SILVER
from helpers import facts as fact_frame
from helpers import rows, silver

D0 = date(2026, 1, 15)


def same_schema(df, schema):
    """Names and types; whether a column may hold nulls is left to Spark."""
    assertSchemaEqual(df.schema, schema, ignoreNullable=True)


def ten_events(spark):
    types = ["page_view", "purchase", "page_view", "click", "page_view", "add_to_cart",
             "page_view", "purchase", "page_view", "page_view"]
    amounts = {1: ("50.0", "5.0"), 7: ("75.0", "7.5")}
    return fact_frame(
        spark,
        [
            {"user_id": f"u{i // 2 + 1}", "event_type": t, "event_date": D0,
             "revenue": Decimal(amounts.get(i, ("0", "0"))[0]),
             "cashback_amount": Decimal(amounts.get(i, ("0", "0"))[1])}
            for i, t in enumerate(types)
        ],
    )


def test_daily_kpis_of_ten_events(spark):
    out = kpis.daily_kpis(ten_events(spark))
    same_schema(out, DAILY_KPIS)
    r = out.first()
    assert (r.dau, r.page_views, r.purchases, r.clicks, r.add_to_carts) == (5, 6, 2, 1, 1)
    assert (r.daily_revenue, r.daily_cashback) == (Decimal("125.00"), Decimal("0.00"))
    assert (r.conversion_rate, r.avg_order_value, r.revenue_per_user) == (33.3333, 62.5, 25.0)
    assert (r.purchasing_users, r.wau, r.mobile_users, r.desktop_users) == (2, 5, 5, 0)


def test_daily_kpis_without_views_or_purchases(spark):
    r = kpis.daily_kpis(fact_frame(spark, [{"event_type": "refund", "revenue": Decimal("-9.50")}])).first()
    assert (r.conversion_rate, r.avg_order_value, r.revenue_per_user) == (0.0, 0.0, 0.0)
    assert (r.daily_refunds, r.daily_revenue, r.products_sold) == (Decimal("9.50"), Decimal("0.00"), 0)
    empty = kpis.daily_kpis(fact_frame(spark, []))
    assert empty.count() == 0


def test_daily_distincts_ignore_nulls_and_equal_spark_counts(spark):
    rng = random.Random(1)
    pick = lambda *v: rng.choice(v)
    f = fact_frame(
        spark,
        [
            {"event_date": D0 + timedelta(days=rng.randrange(3)), "user_id": pick("a", "b", "c", "d"),
             "session_id": pick("s1", "s2", "s3", None), "product_id": pick("p1", "p2", "p3", None),
             "event_type": pick("purchase", "click"), "device_type": pick("mobile", "desktop", "tablet", "tv")}
            for _ in range(60)
        ],
    )
    want = f.groupBy("event_date").agg(
        F.count_distinct("user_id").alias("dau"),
        F.count_distinct("session_id").alias("daily_sessions"),
        F.expr("count(distinct user_id) filter (where event_type = 'purchase')").alias("purchasing_users"),
        F.expr("count(distinct product_id) filter (where event_type = 'purchase')").alias("products_sold"),
        *[
            F.expr(f"count(distinct user_id) filter (where device_type = '{d}')").alias(f"{d}_users")
            for d in ("mobile", "desktop", "tablet")
        ],
    )
    assert rows(kpis.daily_distincts(f)) == rows(want)


def days_frame(spark, pairs):
    return spark.createDataFrame(pairs, "user_id string, event_date date")


def brute_wau(pairs, window=7):
    days = sorted({d for _, d in pairs})
    return [
        (d, len({u for u, e in pairs if d - timedelta(days=window) < e <= d})) for d in days
    ]


def test_rolling_users_at_the_edges_of_the_window(spark):
    at = lambda n: D0 + timedelta(days=n)
    pairs = [("a", at(0)), ("a", at(6)), ("b", at(0)), ("b", at(7)), ("c", at(20)), ("d", at(8))]
    got = rows(activity.rolling_active_users(days_frame(spark, pairs)))
    assert got == brute_wau(pairs) == [(at(0), 2), (at(6), 2), (at(7), 2), (at(8), 3), (at(20), 1)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rolling_users_against_brute_force(spark, seed):
    rng = random.Random(seed)
    pairs = {(f"u{rng.randrange(15)}", D0 + timedelta(days=rng.randrange(40))) for _ in range(120)}
    df = days_frame(spark, sorted(pairs))
    assert rows(activity.rolling_active_users(df)) == brute_wau(pairs)
    since = str(D0 + timedelta(days=25))
    recent = [r for r in brute_wau(pairs) if str(r[0]) >= since]
    assert rows(activity.rolling_active_users(df, since=since)) == recent
    assert rows(activity.rolling_active_users(df, window=3)) == brute_wau(pairs, 3)


def test_sketched_weekly_users_are_close(spark):
    rng = random.Random(5)
    pairs = sorted({(f"u{rng.randrange(2000)}", D0 + timedelta(days=rng.randrange(12))) for _ in range(6000)})
    exact = dict(rows(activity.rolling_active_users(days_frame(spark, pairs))))
    near = dict(rows(activity.rolling_active_users_approx(days_frame(spark, pairs))))
    assert near.keys() == exact.keys()
    assert all(abs(near[d] - exact[d]) <= 0.1 * exact[d] for d in exact)


def test_user_days_of_a_hot_user(spark):
    f = fact_frame(spark, [{"user_id": "hot", "event_date": D0}] * 500 + [{"user_id": "cold"}])
    assert activity.user_days(f).count() == 2


def test_retention_windows(spark):
    monday = date(2026, 1, 12)
    back = [0, 1, 3, 7, 14, 30]
    pairs = [("comes_back", monday + timedelta(days=n)) for n in back] + [("gone", monday + timedelta(days=6))]
    out = retention.retention(days_frame(spark, pairs))
    same_schema(out, RETENTION)
    r = out.first()
    assert (r.cohort_week, r.cohort_size) == (monday, 2)
    assert [r[f"retained_day_{d}"] for d in (1, 3, 7, 14, 30)] == [1] * 5
    assert [r[f"retention_rate_day_{d}"] for d in (1, 30)] == [50.0, 50.0]
    assert [r[f"retention_rate_week_{w}"] for w in (1, 2, 3, 4)] == [50.0, 50.0, 0.0, 0.0]


def test_rows_without_user_belong_to_no_cohort(spark):
    days = days_frame(spark, [("a", D0), (None, D0)])
    assert rows(retention.retention(days), "cohort_size") == [(1,)]
    assert rows(activity.rolling_active_users(days)) == [(D0, 1)]


def test_retention_equals_conditional_distinct_counts(spark):
    rng = random.Random(7)
    pairs = sorted({(f"u{rng.randrange(40)}", D0 + timedelta(days=rng.randrange(60))) for _ in range(250)})
    days = days_frame(spark, pairs)
    literal = (
        activity.cohort_activity(days)
        .groupBy(F.trunc("cohort_date", "week").alias("cohort_week"))
        .agg(
            F.count_distinct("user_id").alias("cohort_size"),
            *[
                F.expr(f"count(distinct user_id) filter (where days_since_signup = {d})").alias(f"retained_day_{d}")
                for d in (1, 3, 7, 14, 30)
            ],
        )
    )
    assert rows(retention.retention(days), *literal.columns) == rows(literal)


def test_funnel_may_invert_and_always_has_five_rows(spark):
    f = fact_frame(
        spark,
        [{"user_id": u, "event_type": t} for u, t in
         [("a", "page_view"), ("b", "page_view"), ("a", "click"), ("a", "add_to_cart"),
          ("b", "add_to_cart"), ("c", "add_to_cart"), ("a", "refund"), ("a", "cashback_earned")]],
    )
    out = funnel.funnel_analysis(f)
    same_schema(out, FUNNEL)
    assert rows(out) == [
        (1, "page_view", 2, 2, 100.0, 100.0, 0, 0.0),
        (2, "click", 1, 1, 50.0, 50.0, 1, 50.0),
        (3, "add_to_cart", 3, 3, 150.0, 300.0, -2, -200.0),
        (4, "purchase", 0, 0, 0.0, 0.0, 3, 100.0),
        (5, "cashback_earned", 1, 1, 50.0, 100.0, -1, 0.0),
    ]
    empty = rows(funnel.funnel_analysis(fact_frame(spark, [])))
    assert [r[2:] for r in empty] == [(0, 0, 0.0, 100.0, 0, 0.0)] * 5


def test_modes_take_the_smallest_of_ties_and_skip_nulls(spark):
    values = {"a": ["z", "z", "y", "y", None, None, None], "b": ["q", "r", "r"], "c": [None]}
    f = fact_frame(
        spark, [{"user_id": u, "device_type": v, "city": "t"} for u, vs in values.items() for v in vs]
    )
    got = {r.user_id: (r.primary_device, r.city) for r in users.user_modes(f).collect()}
    assert got == {"a": ("y", "t"), "b": ("r", "t"), "c": (None, "t")}
    want = f.groupBy("user_id").agg(F.mode("device_type", True).alias("primary_device"))
    assert {u: d for u, (d, _) in got.items()} == dict(rows(want))


def test_dim_users(spark):
    as_of = "2026-03-01"
    rows_in = [
        {"user_id": "buyer", "event_type": "purchase", "revenue": Decimal("10.01"), "event_date": D0},
        {"user_id": "buyer", "event_type": "purchase", "revenue": Decimal("10.02"), "event_date": date(2026, 2, 25)},
        {"user_id": "buyer", "event_type": "page_view", "session_id": "s2"},
        {"user_id": "buyer", "event_type": "cashback_earned", "cashback_amount": Decimal("1.00")},
        {"user_id": "buyer", "event_type": "refund", "revenue": Decimal("-10.01"), "cashback_amount": Decimal("-0.50")},
        {"user_id": "idle", "event_type": "click", "event_date": D0, "product_id": None, "session_id": None},
    ]
    out = users.dim_users(silver(spark, rows_in), as_of)
    same_schema(out, DIM_USERS)
    b, idle = out.orderBy("user_id").collect()
    assert (b.total_events, b.purchases, b.refunds, b.active_days, b.total_sessions) == (5, 2, 1, 2, 2)
    assert (b.total_revenue, b.total_cashback) == (Decimal("20.03"), Decimal("1.00"))
    assert (b.conversion_rate, b.avg_order_value) == (200.0, 10.02)
    assert (b.account_age_days, b.days_since_last_active) == (45, 4)
    assert (b.user_segment, b.lifecycle_stage) == ("casual_buyer", "active")
    assert (idle.user_segment, idle.lifecycle_stage) == ("churned", "dormant")
    assert (idle.total_sessions, idle.unique_products_viewed, idle.avg_order_value) == (0, 0, 0.0)


def test_staging_and_fact_columns(spark):
    s = silver(spark, [
        {"event_id": "a", "event_date": date(2024, 1, 6), "event_hour": 13, "revenue": Decimal("1.00")},
        {"event_id": "b", "revenue": Decimal("-1.00"), "event_type": "refund", "city": None, "event_hour": None},
        {"event_id": "c", "is_valid": False},
    ])
    stg = facts.stg_events(s)
    same_schema(stg, SILVER)
    fact = facts.fact_events(stg)
    same_schema(fact, FACT)
    a, b = fact.orderBy("event_id").collect()
    assert (a.day_of_week, a.event_month, a.event_year, a.is_weekend) == (6, 1, 2024, True)
    assert (a.time_of_day, a.is_revenue_event, a.is_cashback_event) == ("lunch", True, False)
    assert (b.time_of_day, b.is_revenue_event, b.city) == ("night", False, "unknown")


def test_lookup_marks_refunds_but_the_fact_does_not(spark):
    f = facts.fact_events(silver(spark, [{"event_type": "refund", "revenue": Decimal("-5.00")}]))
    r = facts.by_event_type(f, facts.event_types(spark)).first()
    assert (r.is_revenue_type, r.revenue_events, r.funnel_order) == (True, 0, 6)
    assert facts.event_types(spark).count() == 6
