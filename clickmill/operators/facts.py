"""Staging view and the enriched event fact."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.functions import columns as C
from clickmill.operators.silver import fill_defaults, valid
from clickmill.schemas import EVENT_TYPE_ROWS, FACT, MONEY, SILVER


def stg_events(silver: DataFrame) -> DataFrame:
    """Valid rows with defaults and two-digit money."""
    money = {c: F.col(c).cast(MONEY) for c in ("product_price", "revenue", "cashback_amount")}
    return valid(silver).transform(fill_defaults).withColumns(money).select(SILVER.fieldNames())


def fact_events(stg: DataFrame) -> DataFrame:
    return stg.withColumns(
        {
            "day_of_week": C.day_of_week("event_date"),
            "event_month": F.month("event_date"),
            "event_year": F.year("event_date"),
            "is_weekend": C.is_weekend("event_date"),
            "time_of_day": C.time_of_day("event_hour"),
            "is_revenue_event": F.coalesce(F.col("revenue") > 0, F.lit(False)),
            "is_cashback_event": F.coalesce(F.col("cashback_amount") > 0, F.lit(False)),
        }
    ).select(FACT.fieldNames())


def event_types(spark: SparkSession) -> DataFrame:
    """The six-row event-type lookup table."""
    return spark.createDataFrame(
        EVENT_TYPE_ROWS, "event_type string, description string, is_revenue_event boolean, funnel_order int"
    )


def by_event_type(fact: DataFrame, types: DataFrame) -> DataFrame:
    """Event counts and revenue with the description of each type; the lookup holds six rows.

    `is_revenue_type` is the lookup's flag, `revenue_events` counts by amount: refunds differ.
    """
    totals = fact.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if("is_revenue_event").alias("revenue_events"),
        F.sum("revenue").alias("revenue"),
    )
    lookup = types.withColumnRenamed("is_revenue_event", "is_revenue_type")
    return totals.join(F.broadcast(lookup), "event_type")
