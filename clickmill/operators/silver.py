"""Bronze to silver: de-duplication, validity flags, repairs, defaults."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.schemas import EVENT_TYPES, MIN_EVENT_DATE, SILVER, UNKNOWN

NUMBERS = ["product_price", "quantity", "revenue", "cashback_amount"]
ATTRIBUTES = ["device_type", "browser", "country", "city"]
CRITICAL = ["event_id", "user_id", "event_type", "event_timestamp"]


def dedup_events(df: DataFrame) -> DataFrame:
    """One row per event id (null ids count as one): the earliest, then the smallest payload.

    The rank filter is applied before the shuffle as well, so that each task passes on at most one
    row per id and an id with very many copies does not gather in one task.
    """
    first = [c for c in ("event_timestamp", "ingested_at") if c in df.columns]
    rest = sorted(set(df.columns) - {"event_id", *first})
    order = Window.partitionBy("event_id").orderBy(*first, *rest)
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def null_flags() -> list[Column]:
    """A flag for each critical column without a value."""
    return [F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in CRITICAL]


def type_flag() -> Column:
    """Unknown types; a null type has its own flag already."""
    return F.when(~F.col("event_type").isin(EVENT_TYPES), "invalid_event_type")


def time_flag(now: str) -> Column:
    """Times after `now` or before 2020; with a time in that range, days outside of it.

    A day that differs from the time's own is left alone, as sources may write local days.
    """
    at, on = F.col("event_timestamp"), F.col("event_date")
    latest, earliest = F.lit(now).cast("timestamp_ntz"), F.lit(MIN_EVENT_DATE).cast("timestamp_ntz")
    return (
        F.when(at > latest, "future_timestamp")
        .when(at < earliest, "ancient_timestamp")
        .when(~on.between(earliest.cast("date"), latest.cast("date")), "invalid_event_date")
    )


def flag_rows(df: DataFrame, now: str) -> DataFrame:
    """`quality_flags`, all reasons against a row, and `is_valid` where there are none."""
    reasons = F.array_compact(F.array(*null_flags(), type_flag(), time_flag(now)))
    return df.withColumns(
        {"quality_flags": F.array_join(reasons, ","), "is_valid": F.size(reasons) == 0}
    )


def repair_prices(df: DataFrame) -> DataFrame:
    """Negative prices lose their sign, except on refunds."""
    price = F.col("product_price")
    wrong = (price < 0) & (F.col("event_type") != "refund")
    return df.withColumn("product_price", F.when(wrong, F.abs(price)).otherwise(price))


def fill_defaults(df: DataFrame) -> DataFrame:
    """0 for missing numbers (in the column's own type) and `unknown` for devices and places."""
    return df.fillna(0, [c for c in NUMBERS if c in df.columns]).fillna(
        UNKNOWN, [c for c in ATTRIBUTES if c in df.columns]
    )


def add_derived(df: DataFrame, now: str) -> DataFrame:
    return df.withColumns(
        {"event_hour": F.hour("event_timestamp"), "cleaned_at": F.lit(now).cast("timestamp_ntz")}
    )


def silver_columns(df: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """The silver columns in order, then `also`; absent ones are left out."""
    return df.select([c for c in (*SILVER.fieldNames(), *also) if c in df.columns])


def clean(bronze: DataFrame, now: str, also: Sequence[str] = ()) -> DataFrame:
    """All rows, valid or not, in the silver schema and the columns `also`; lazy, with one shuffle."""
    return (
        bronze.transform(dedup_events)
        .transform(flag_rows, now)
        .transform(repair_prices)
        .transform(fill_defaults)
        .transform(add_derived, now)
        .transform(silver_columns, also)
    )


def valid(silver: DataFrame) -> DataFrame:
    return silver.where("is_valid")


def quarantined(silver: DataFrame) -> DataFrame:
    return silver.where(~F.col("is_valid"))
