from datetime import date
from decimal import Decimal

from clickmill.functions.calendar import date_spine
from clickmill.operators import reports as R
from clickmill.schemas import DAILY_KPIS, DIM_USERS
from helpers import rows

D = [date(2026, 1, d) for d in (1, 2, 4)]


def kpis(spark, days=D):
    values = []
    for i, d in enumerate(days):
        row = dict.fromkeys(DAILY_KPIS.fieldNames(), 0)
        row |= {c: Decimal(0) for c in ("daily_revenue", "daily_cashback", "daily_refunds")}
        row |= {c: 0.0 for c in ("conversion_rate", "avg_order_value", "revenue_per_user")}
        row |= {"event_date": d, "dau": 10 * i, "wau": 100, "daily_revenue": Decimal(5 * i),
                "mobile_users": i, "desktop_users": 2 * i}
        values.append(tuple(row[c] for c in DAILY_KPIS.fieldNames()))
    return spark.createDataFrame(values, DAILY_KPIS)


def users(spark, totals, **extra):
    values = []
    for i, total in enumerate(totals):
        row = dict.fromkeys(DIM_USERS.fieldNames())
        row |= {"user_id": f"u{i}", "total_revenue": Decimal(total), "purchases": int(Decimal(total) > 0),
                "total_sessions": i, "user_segment": "regular", **extra}
        values.append(tuple(row[c] for c in DIM_USERS.fieldNames()))
    return spark.createDataFrame(values, DIM_USERS)


def test_cards_compare_the_last_two_days_in_the_table(spark):
    r = R.kpi_cards(kpis(spark)).first()
    assert (r.event_date, r.dau, r.dau_change, r.revenue_change) == (D[2], 20, 10, Decimal("5.00"))
    only = R.kpi_cards(kpis(spark, D[:1])).first()
    assert (only.event_date, only.dau_change, only.revenue_change) == (D[0], 0, Decimal("0.00"))
    assert R.kpi_cards(kpis(spark, [])).count() == 0


def test_spine_fills_missing_days(spark):
    out = R.date_spine_kpis(kpis(spark), date_spine(spark, "2026-01-01", "2026-01-05"))
    assert [(r.event_date.day, r.dau) for r in out.collect()] == [(1, 0), (2, 10), (3, 0), (4, 20), (5, 0)]


def test_devices_of_the_latest_day(spark):
    got = rows(R.device_breakdown(kpis(spark)), "device", "users")
    assert got == [("Desktop", 4), ("Mobile", 2), ("Tablet", 0)]


def test_histogram(spark):
    out = rows(R.revenue_histogram(users(spark, ["0", "1", "1.99", "2", "50.99", "51"])))
    assert [(r[0], r[1]) for r in out] == [(1, 2), (2, 1), (50, 2)]
    assert out[0][2:] == (1.0, 2.0) and out[-1][2:] == (50.0, 51.0)
    same = rows(R.revenue_histogram(users(spark, ["7", "7", "0"])))
    assert same == [(1, 2, 7.0, 7.0)]
    assert R.revenue_histogram(users(spark, ["0"])).count() == 0


def test_summary_and_shares(spark):
    df = users(spark, ["0", "1", "1.99"])
    assert tuple(R.user_summary(df).first()) == (3, 1.0, 66.7, 1.0)
    assert rows(R.user_segments(df)) == [("regular", 3, 100.0)]
    assert tuple(R.user_summary(users(spark, [])).first()) == (0, 0.0, 0.0, 0.0)


def test_totals_ascend(spark):
    df = spark.createDataFrame(
        [("a", D[0], 5), ("b", D[0], 1), ("a", D[1], 5)], "event_type string, event_date date, event_count long"
    )
    assert [tuple(r) for r in R.event_totals(df).collect()] == [("b", 1), ("a", 10)]
