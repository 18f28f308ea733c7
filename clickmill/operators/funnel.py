"""Unordered conversion funnel over the whole fact."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmill.functions import columns as C
from clickmill.schemas import FUNNEL, FUNNEL_STAGES


def stage_counts(fact: DataFrame) -> DataFrame:
    """Users and events per type; users are made distinct before they are counted per type."""
    return fact.groupBy("event_type").agg(
        F.count_distinct("user_id").alias("unique_users"), F.count(F.lit(1)).alias("total_events")
    )


def funnel_analysis(fact: DataFrame) -> DataFrame:
    """Always five rows. A stage counts a user who had the event at any time."""
    return funnel_rates(stage_counts(fact.where(F.col("event_type").isin(FUNNEL_STAGES))))


def funnel_rates(counts: DataFrame) -> DataFrame:
    """The five stages with their rates, from users and events per type (at most five rows)."""
    rows = ", ".join(f"({i}, '{name}')" for i, name in enumerate(FUNNEL_STAGES, 1))
    stages = counts.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(stage_order, stage_name)")
    users, order = F.col("unique_users"), Window.orderBy("stage_order")
    return (
        stages.join(F.broadcast(counts), F.col("stage_name") == F.col("event_type"), "left")
        .fillna(0, ["unique_users", "total_events"])
        .withColumns({"first": F.first(users).over(order), "previous": F.lag(users).over(order)})
        .withColumns(
            {
                "overall_conversion_rate": C.percentage(users, "first"),
                "step_conversion_rate": F.when(
                    F.col("previous") > 0, C.percentage(users, "previous")
                ).otherwise(100.0),
                "dropoff_count": F.coalesce(F.col("previous") - users, F.lit(0)),
            }
        )
        .withColumn("dropoff_rate", C.percentage("dropoff_count", "previous"))
        .select(FUNNEL.fieldNames())
    )
