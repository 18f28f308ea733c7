from datetime import date, datetime
from decimal import Decimal

from clickmill.schemas import FACT, RAW, SILVER

DEFAULTS = {
    "event_id": "e", "user_id": "u", "event_type": "page_view",
    "event_timestamp": datetime(2026, 1, 15, 10), "event_date": date(2026, 1, 15),
    "page_url": "/", "product_id": "p1", "product_name": "thing", "product_category": "things",
    "product_price": Decimal("1.00"), "quantity": 0, "revenue": Decimal("0.00"),
    "cashback_amount": Decimal("0.00"), "device_type": "mobile", "browser": "Chrome",
    "country": "X", "city": "Y", "session_id": "s1", "referrer": None, "event_hour": 10,
    "is_valid": True, "quality_flags": "", "cleaned_at": datetime(2026, 2, 1),
    "day_of_week": 4, "event_month": 1, "event_year": 2026, "is_weekend": False,
    "time_of_day": "morning", "is_revenue_event": False, "is_cashback_event": False,
}


def _frame(spark, schema, rows):
    data = []
    for i, row in enumerate(rows):
        full = {**DEFAULTS, "event_id": f"e{i}", **row}
        if "event_date" in row and "event_timestamp" not in row and row["event_date"]:
            full["event_timestamp"] = datetime.combine(row["event_date"], datetime.min.time())
        data.append(tuple(full[c] for c in schema.fieldNames()))
    return spark.createDataFrame(data, schema)


def typed(spark, rows):
    """Typed raw events (the silver input) from partial rows."""
    from pyspark.sql import types as T

    schema = T.StructType([SILVER[c] for c in RAW.fieldNames()])
    return _frame(spark, schema, rows)


def silver(spark, rows):
    return _frame(spark, SILVER, rows)


def facts(spark, rows):
    return _frame(spark, FACT, rows)


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def write_csv(path, header, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *lines]) + "\n")
