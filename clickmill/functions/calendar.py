"""Calendar tables."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.functions.columns import day


def date_spine(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """One row per day, both ends included."""
    first, last = date.fromisoformat(str(start)), date.fromisoformat(str(end))
    days = max((last - first).days + 1, 0)
    return spark.range(days).select(F.date_add(day(first), F.col("id").cast("int")).alias("date_day"))
