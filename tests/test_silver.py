from datetime import date, datetime
from decimal import Decimal

from clickmill.operators import silver as S
from clickmill.schemas import SILVER
from helpers import plan, rows, typed

NOW = "2026-02-01 00:00:00"


def six_events(spark):
    def at(hour, day=date(2026, 1, 15)):
        return {"event_timestamp": datetime(day.year, day.month, day.day, hour), "event_date": day}

    one = {"event_id": "e1", "user_id": "u1", "product_price": Decimal("10.99"), **at(10)}
    return typed(
        spark,
        [
            one,
            {"event_id": "e2", "user_id": "u2", "event_type": "click", "device_type": "desktop", **at(11)},
            {"event_id": "e3", "user_id": None, "event_type": "purchase", "device_type": None,
             "quantity": 2, "revenue": Decimal("199.98"), **at(12)},
            {"event_id": "e4", "user_id": "u4", "event_type": "", "product_price": Decimal("-15.00"), **at(13)},
            {"event_id": "e5", "user_id": "u5", "device_type": "tablet", **at(14, date(2027, 6, 15))},
            one,
        ],
    )


def test_six_event_fixture(spark):
    out = S.clean(six_events(spark), NOW)
    assert out.schema.simpleString() == SILVER.simpleString()
    assert rows(S.valid(out), "event_id") == [("e1",), ("e2",)]
    assert rows(S.quarantined(out), "event_id", "quality_flags", "device_type") == [
        ("e3", "null_user_id", "unknown"),
        ("e4", "invalid_event_type", "mobile"),
        ("e5", "future_timestamp", "tablet"),
    ]
    assert out.where("event_id = 'e4'").first().product_price == Decimal("15.00")
    assert out.where("event_id = 'e1'").first().event_hour == 10


def test_flags(spark):
    df = typed(
        spark,
        [
            {"event_id": None},
            {"user_id": None, "event_type": "swipe"},
            {"event_type": None},
            {"event_timestamp": None},
            {"event_timestamp": datetime(2019, 12, 31, 23, 59, 59)},
            {"event_timestamp": datetime(2020, 1, 1)},
            {"event_timestamp": datetime(2026, 2, 1)},
            {"event_timestamp": datetime(2026, 2, 1, 0, 0, 1), "event_type": "swipe"},
        ],
    )
    out = S.flag_rows(df, NOW)
    assert [(r.is_valid, r.quality_flags) for r in out.collect()] == [
        (False, "null_event_id"),
        (False, "null_user_id,invalid_event_type"),
        (False, "null_event_type"),
        (False, "null_event_timestamp"),
        (False, "ancient_timestamp"),
        (True, ""),
        (True, ""),
        (False, "invalid_event_type,future_timestamp"),
    ]


def test_price_repair_spares_refunds_and_null_types(spark):
    price = Decimal("-2.00")
    df = typed(spark, [{"product_price": price, "event_type": t} for t in ("click", "refund", None)])
    assert [r.product_price for r in S.repair_prices(df).collect()] == [-price, price, price]


def test_defaults_keep_decimals(spark):
    empty = ["product_price", "quantity", "revenue", "cashback_amount", "device_type", "browser", "country", "city"]
    out = S.fill_defaults(typed(spark, [dict.fromkeys(empty)]))
    assert tuple(out.select(empty).first()) == (
        Decimal("0.00"), 0, Decimal("0.00"), Decimal("0.00"), *["unknown"] * 4)
    assert dict(out.dtypes)["revenue"] == "decimal(12,2)"
    partial = S.fill_defaults(typed(spark, [{}]).drop("city"))
    assert "city" not in partial.columns


def test_dedup_keeps_the_earliest_and_one_null_id(spark):
    df = typed(
        spark,
        [
            {"event_id": "a", "event_timestamp": datetime(2026, 1, 2), "revenue": Decimal("1.00")},
            {"event_id": "a", "event_timestamp": datetime(2026, 1, 1), "revenue": Decimal("3.00")},
            {"event_id": "a", "event_timestamp": datetime(2026, 1, 1), "revenue": Decimal("2.00")},
            {"event_id": None, "user_id": "x"},
            {"event_id": None, "user_id": "y"},
        ],
    )
    got = {(r.event_id, r.user_id, r.revenue) for r in S.dedup_events(df).collect()}
    assert got == {("a", "u", Decimal("2.00")), (None, "x", Decimal("0.00"))}


def test_dedup_drops_copies_before_the_shuffle(spark):
    text = plan(S.dedup_events(typed(spark, [{}])))
    partial, shuffle = text.index("Partial"), text.index("Exchange hashpartitioning(event_id")
    assert "WindowGroupLimit" in text and partial > shuffle  # plans read from the top down


def test_clean_has_one_shuffle_and_no_python(spark):
    text = plan(S.clean(six_events(spark), NOW))
    assert text.count("Exchange") == 1 and "Python" not in text


def test_absent_columns_are_left_out(spark):
    out = S.silver_columns(typed(spark, [{}]).drop("referrer"))
    assert "referrer" not in out.columns and out.columns[0] == "event_id"
