"""The aggregates behind the dashboard, computed on the published tables."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmill.functions import columns as C
from clickmill.schemas import DEVICES, RETENTION_DAYS, RETENTION_WEEKS

HISTOGRAM_BINS = 50


def kpi_cards(kpis: DataFrame) -> DataFrame:
    """The latest day and its change against the day before it in the table."""
    latest = kpis.orderBy(F.desc("event_date")).limit(2)

    def now(c: str) -> Column:
        return F.max_by(c, "event_date")

    def change(c: str) -> Column:
        return now(c) - F.min_by(c, "event_date")

    return latest.agg(
        F.max("event_date").alias("event_date"),
        *[now(c).alias(c) for c in ("dau", "wau", "daily_revenue", "daily_cashback", "conversion_rate")],
        change("dau").alias("dau_change"),
        change("daily_revenue").alias("revenue_change"),
    ).where(F.col("event_date").isNotNull())


def kpi_trends(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        "event_date", "dau", "wau", "daily_revenue", "daily_cashback", "conversion_rate"
    ).orderBy("event_date")


def funnel_report(funnel: DataFrame) -> DataFrame:
    """Stages with display names and their share of the first stage."""
    return funnel.select(
        "stage_order",
        C.label("stage_name").alias("stage_label"),
        "unique_users",
        F.col("overall_conversion_rate").alias("percent_of_initial"),
        "step_conversion_rate",
        "dropoff_count",
    ).orderBy("stage_order")


def retention_heatmap(retention: DataFrame) -> DataFrame:
    """One row per cohort and period."""
    periods = [f"day_{d}" for d in RETENTION_DAYS if d] + [f"week_{w}" for w in RETENTION_WEEKS]
    columns = [f"retention_rate_{p}" for p in periods]
    return retention.unpivot(["cohort_week"], columns, "period", "retention_rate").withColumn(
        "period", C.label(F.replace(F.col("period"), F.lit("retention_rate_"), F.lit("")))
    )


def cohort_sizes(retention: DataFrame) -> DataFrame:
    return retention.select("cohort_week", "cohort_size").orderBy("cohort_week")


def _shares(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows per value and their share of all rows.

    The window without a key spans the counts, one row for each of a handful of fixed values.
    """
    counts = df.groupBy(F.col(column).alias(name)).agg(F.count(F.lit(1)).alias("users"))
    total = F.sum("users").over(Window.partitionBy())
    return counts.withColumn("share", C.percentage("users", total)).orderBy(F.desc("users"), name)


def user_segments(users: DataFrame) -> DataFrame:
    return _shares(users, "user_segment", "segment")


def lifecycle_stages(users: DataFrame) -> DataFrame:
    return _shares(users, "lifecycle_stage", "stage")


def user_summary(users: DataFrame) -> DataFrame:
    """Users, mean revenue, share of buyers, mean sessions."""
    return users.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.coalesce(F.sum("total_revenue"), F.lit(0)).alias("revenue"),
        F.count_if(F.col("purchases") > 0).alias("buyers"),
        F.coalesce(F.sum("total_sessions"), F.lit(0)).alias("sessions"),
    ).select(
        "total_users",
        C.safe_divide("revenue", "total_users").alias("avg_revenue"),
        C.percentage("buyers", "total_users", places=1).alias("buyer_pct"),
        C.safe_divide("sessions", "total_users", places=1).alias("avg_sessions"),
    )


def revenue_histogram(users: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Paying users in equal revenue bins between the smallest and the largest total.

    Bins are found on whole cents; the largest total belongs to the last bin. Empty bins have no
    row. The bounds are one row, read as a scalar subquery.
    """
    cents = users.where(F.col("total_revenue") > 0).select(
        (F.col("total_revenue") * 100).cast("bigint").alias("cents")
    )
    bounds = cents.agg(F.struct(F.min("cents").alias("lo"), F.max("cents").alias("hi")).alias("b"))
    lo, width = F.col("bounds.lo"), F.col("bounds.hi") - F.col("bounds.lo")
    position = F.floor((F.col("cents") - lo) * bins / F.nullif(width, F.lit(0)))
    number = F.least(F.coalesce(position.cast("int"), F.lit(0)) + 1, F.lit(bins))

    def edge(steps: Column) -> Column:
        return (F.col("lo") * bins + F.col("width") * steps).cast("double") / (100.0 * bins)

    return (
        cents.withColumn("bounds", bounds.scalar())
        .groupBy(number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("users"), F.min(lo).alias("lo"), F.min(width).alias("width"))
        .select(
            "bin",
            "users",
            edge(F.col("bin") - 1).alias("bin_start"),
            edge(F.col("bin")).alias("bin_end"),
        )
        .orderBy("bin")
    )


def event_distribution(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("event_type", "event_date")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy("event_date", "event_type")
    )


def event_totals(distribution: DataFrame) -> DataFrame:
    return (
        distribution.groupBy("event_type")
        .agg(F.sum("event_count").alias("event_count"))
        .orderBy("event_count", "event_type")
    )


def device_breakdown(kpis: DataFrame) -> DataFrame:
    """Users per device on the latest day."""
    last = kpis.orderBy(F.desc("event_date")).limit(1)
    return last.unpivot(
        ["event_date"], [f"{d}_users" for d in DEVICES], "device", "users"
    ).withColumn("device", F.initcap(F.replace(F.col("device"), F.lit("_users"), F.lit(""))))


def date_spine_kpis(kpis: DataFrame, spine: DataFrame) -> DataFrame:
    """Daily figures on every calendar day, 0 on days without events."""
    return (
        spine.withColumnRenamed("date_day", "event_date")
        .join(kpis, "event_date", "left")
        .fillna(0)
        .orderBy("event_date")
    )
