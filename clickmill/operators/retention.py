"""Weekly cohort retention."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.functions import columns as C
from clickmill.operators.activity import cohort_activity
from clickmill.schemas import RETENTION, RETENTION_DAYS, RETENTION_WEEKS

WINDOWS = {
    **{f"day_{d}": (d, d) for d in RETENTION_DAYS},
    **{f"week_{w}": span for w, span in RETENTION_WEEKS.items()},
}


def retention_flags(days: DataFrame) -> DataFrame:
    """One row per user: first day, and whether the user came back in each window."""
    after = F.col("days_since_signup")
    return (
        cohort_activity(days)
        .groupBy("user_id")
        .agg(
            F.min("cohort_date").alias("cohort_date"),
            *[F.max(after.between(lo, hi)).alias(name) for name, (lo, hi) in WINDOWS.items()],
        )
    )


def retention(days: DataFrame) -> DataFrame:
    """Cohorts by week of first activity; rates are percentages of the whole cohort.

    The per-user flags come from the same hash partitions as the cohort window and are then simply
    summed, where a distinct count per window would copy every row once per window.
    """
    counts = (
        retention_flags(days)
        .groupBy(C.start_of_week("cohort_date").alias("cohort_week"))
        .agg(
            F.count(F.lit(1)).alias("cohort_size"),
            *[F.count_if(name).alias(f"retained_{name}") for name in WINDOWS],
        )
    )
    rates = {
        f"retention_rate_{name}": C.percentage(f"retained_{name}", "cohort_size") for name in WINDOWS
    }
    return counts.withColumns(rates).select(RETENTION.fieldNames())
