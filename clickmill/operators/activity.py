"""User-day activity: rolling active users and cohorts."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmill.functions.columns import day


def user_days(fact: DataFrame) -> DataFrame:
    """Distinct (user_id, event_date): at most one row per user and calendar day."""
    return fact.select("user_id", "event_date").distinct()


def rolling_active_users(days: DataFrame, window: int = 7, since: str | None = None) -> DataFrame:
    """`event_date`, `wau`: distinct users of the day and the `window - 1` days before it.

    An active day counts for itself and the days after it, up to the user's next active day. These
    stretches never overlap for one user, so counting them needs no distinct: the exploded rows are
    summed up per day before they are shuffled. Only days with events are returned; `since` limits
    the result to later days and the input to what those need.
    """
    if since:
        days = days.where(F.col("event_date") >= F.date_sub(day(since), window - 1))
    following = F.lead("event_date").over(Window.partitionBy("user_id").orderBy("event_date"))
    last = F.least(F.date_add("event_date", window - 1), F.date_sub(following, 1))
    counted = (
        days.where(F.col("user_id").isNotNull() & F.col("event_date").isNotNull())
        .withColumn("reach", F.datediff(last, "event_date"))
        .select("event_date", F.explode(F.sequence(F.lit(0), "reach")).alias("later"))
        .groupBy(F.date_add("event_date", F.col("later")).alias("day"))
        .agg(F.count(F.lit(1)).alias("wau"), F.count_if(F.col("later") == 0).alias("own"))
        .where("own > 0")
        .select(F.col("day").alias("event_date"), "wau")
    )
    return counted.where(F.col("event_date") >= day(since)) if since else counted


def rolling_active_users_approx(fact: DataFrame, window: int = 7) -> DataFrame:
    """Sketch form of `rolling_active_users`: one small sketch per day, merged over the window."""
    return weekly_estimates(daily_sketches(fact), window)


def daily_sketches(fact: DataFrame) -> DataFrame:
    """`event_date`, `sketch`: a mergeable sketch of the users of each day."""
    return fact.groupBy("event_date").agg(F.hll_sketch_agg("user_id").alias("sketch"))


def weekly_estimates(sketches: DataFrame, window: int = 7) -> DataFrame:
    """`event_date`, `wau` by the days' sketches alone, which may be stored ones."""
    reach = F.sequence("event_date", F.date_add("event_date", window - 1))
    return (
        sketches.select("event_date", "sketch", F.explode(reach).alias("day"))
        .groupBy("day")
        .agg(
            F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("wau"),
            F.count_if(F.col("day") == F.col("event_date")).alias("own"),
        )
        .where("own > 0")
        .select(F.col("day").alias("event_date"), "wau")
    )


def cohort_activity(days: DataFrame) -> DataFrame:
    """Each active day with the user's first one and the days between.

    A window over the user's days, instead of joining them to their minimum.
    """
    return days.where(F.col("user_id").isNotNull()).select(
        "user_id",
        F.min("event_date").over(Window.partitionBy("user_id")).alias("cohort_date"),
        F.col("event_date").alias("activity_date"),
    ).withColumn("days_since_signup", F.datediff("activity_date", "cohort_date"))
