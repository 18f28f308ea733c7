"""Incremental rebuilds that can be rerun and resumed."""

from collections.abc import Callable, Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from clickmill.functions.columns import day
from clickmill.operators.kpis import daily_kpis, weekly_reach
from clickmill.operators.quality import QualityError
from clickmill.operators.user_parts import of_users, user_totals
from clickmill.schemas import LOOKBACK_DAYS, MIN_EVENT_DATE
from clickmill.sources.tables import (
    drop, drop_staged, finish_staged, has_table, observed, read_table, stage, stage_whole, write_table,
)

FACT_SORT = ("user_id", "event_timestamp")


def cutoff(target: DataFrame | None, lookback_days: int = LOOKBACK_DAYS) -> str | None:
    """First day to rebuild: the target's last day less the look-back, as a literal for pruning.

    None before the first write, which is a full one.
    """
    if target is None:
        return None
    last = target.agg(F.max("event_date")).first()[0]
    return str(last - timedelta(days=lookback_days)) if last else MIN_EVENT_DATE


def missed_events(source: DataFrame, target: DataFrame, since: str) -> DataFrame:
    """Source events per day that are older than `since` and not in the target."""
    old = F.col("event_date") < day(since)
    return (
        source.where(old)
        .join(target.where(old).select("event_id"), "event_id", "left_anti")
        .groupBy("event_date")
        .agg(F.count(F.lit(1)).alias("missed"))
    )


def batch_ids(new: DataFrame, path: str) -> None:
    """Write the ids and days of a batch next to the table: the source is read for them once, copies
    of an id are combined, and the joins below know the real size."""
    write_table(new.select("event_id", "event_date").distinct(), f"{path}__ids")


def read_batch_ids(spark: SparkSession, path: str, since: str) -> DataFrame:
    """All written ids; the filter holds for each and tells the planner that they are a selection."""
    return spark.read.parquet(f"{path}__ids").where(F.col("event_date") >= day(since))


def rows_with_ids(target: DataFrame, ids: DataFrame) -> DataFrame:
    """Ids and days of the target's rows that a batch replaces, wherever they lie."""
    return target.select("event_id", "event_date").join(
        ids.select("event_id"), "event_id", "left_semi"
    )


def common_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Those of `ids` that `rows` have; ids alone are shuffled, each once."""
    return rows.select("event_id").join(ids, "event_id", "left_semi").distinct()


def written_ids(ids: DataFrame, path: str) -> DataFrame:
    """The ids from a table of their own, so that what is joined with them is planned for as many as there are."""
    write_table(ids, path)
    return ids.sparkSession.read.schema("event_id string").parquet(path)


def upsert_facts(source: DataFrame, path: str, lookback_days: int = LOOKBACK_DAYS) -> str | None:
    """Bring the fact table up to date by event id; returns the cutoff day.

    Source events from the cutoff on replace the target's rows of the same id, also where the old
    row lies on an earlier day. Only days that gain or lose rows are rewritten.
    """
    spark = source.sparkSession
    finish_staged(spark, path)
    target = read_table(spark, path)
    since = cutoff(target, lookback_days)
    if target is None:
        stage(source, path, sort=FACT_SORT)
    else:
        new = source.where(F.col("event_date") >= day(since))
        batch_ids(new, path)
        ids = read_batch_ids(spark, path, since)
        hit = rows_with_ids(target, ids)
        days = hit.select("event_date").union(ids.select("event_date")).distinct()
        touched: list[date] = [r[0] for r in days.collect()]  # calendar days
        kept = target.where(F.col("event_date").isin(touched)).join(ids.select("event_id"), "event_id", "left_anti")
        stage(kept.unionByName(new), path, touched, FACT_SORT)
        drop(spark, f"{path}__ids")
    finish_staged(spark, path)
    return since


def replace_events(
    rows: DataFrame,
    path: str,
    ids: DataFrame | None,
    partitions: Sequence[date | str],
    sort: Sequence[str] = FACT_SORT,
    key: str = "event_date",
    counts: Mapping[str, Column] | None = None,
) -> dict[str, int]:
    """Put `rows`, all that is now known of the event ids `ids`, in the place of their old rows.

    `partitions` are those that may hold old or new rows of these ids; no others are read or
    written, and one that ends up empty is removed. Without `ids` the table is written anew. The table is
    searched for the ids first, by id alone: most rows of a load are new, and so the kept rows pass by the few
    ids that the table has instead of being shuffled to meet all.

    Returns the number of `rows` and the aggregates `counts` over them, taken as they are written.
    What is written is looked at before it counts: rows without an event id are refused with a
    `QualityError`, and the table stays as it was.
    """
    spark = rows.sparkSession
    finish_staged(spark, path)
    target = read_table(spark, path)
    seen = Observation()
    taken = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col("event_id").isNull()).alias("null_ids")]
    new = rows.observe(seen, *taken, *(c.alias(name) for name, c in (counts or {}).items()))
    if target is None or ids is None:
        stage(new, path, sort=sort, key=key)
    elif partitions:
        old = target.where(F.col(key).isin(list(partitions)))
        held = written_ids(common_ids(old, ids), f"{path}__ids")
        stage(old.join(held, "event_id", "left_anti").unionByName(new), path, partitions, sort, key)
        drop(spark, f"{path}__ids")
    else:  # ids without a place, of rows that were all turned away
        return {"rows": 0, **dict.fromkeys(counts or {}, 0)}
    found = observed(seen, "rows", "null_ids", *(counts or {}))
    if found.pop("null_ids"):
        drop_staged(spark, path)
        raise QualityError(f"rows without an event id for {path}")
    finish_staged(spark, path)
    return found


def replace_days(rows: DataFrame, path: str, days: Sequence[date] | None) -> None:
    """Put `rows` in the place of all rows of `days`; without `days` the table is written anew."""
    spark = rows.sparkSession
    finish_staged(spark, path)
    if days is None or not has_table(spark, path):
        stage(rows, path, sort=("user_id",))
    elif days:
        stage(rows, path, days, ("user_id",))
    finish_staged(spark, path)


def replace_daily(
    figures: Callable[[list[date] | None], DataFrame], spark: SparkSession, path: str, days: Sequence[date] | None
) -> None:
    """Recompute the `figures` of `days` in a table with one row per calendar day; all of them without
    `days` or before the first write."""
    finish_staged(spark, path)
    target = read_table(spark, path)
    if target is None or days is None:
        out = figures(None)
    else:
        out = target.where(~F.col("event_date").isin(list(days))).unionByName(figures(list(days)))
    stage_whole(out.repartition(1), path)
    finish_staged(spark, path)


def replace_daily_kpis(
    figures: Callable[[list[date] | None], DataFrame], spark: SparkSession, path: str, days: Sequence[date] | None
) -> None:
    """`replace_daily` for changed days and the six after each, whose weekly users they enter."""
    replace_daily(figures, spark, path, days if days is None else weekly_reach(days, 1))


def replace_user_totals(days: DataFrame, values: DataFrame, path: str, users: DataFrame | None) -> None:
    """Merge the totals of `users` anew from the parts of their days; the totals of others are carried over
    as they stand. All are merged without `users` or before the first write."""
    spark = days.sparkSession
    finish_staged(spark, path)
    target = read_table(spark, path)
    stage_whole(merged_totals(days, values, target, users), path)
    finish_staged(spark, path)


def merged_totals(
    days: DataFrame, values: DataFrame, target: DataFrame | None, users: DataFrame | None
) -> DataFrame:
    if target is None or users is None:
        return user_totals(days, values)
    fresh = user_totals(of_users(days, users), of_users(values, users))
    return target.join(users, "user_id", "left_anti").unionByName(fresh)


def update_daily_kpis(fact: DataFrame, path: str, lookback_days: int = LOOKBACK_DAYS) -> str | None:
    """Recompute the days from the cutoff on and keep the others; returns the cutoff day.

    The table holds one row per calendar day, so it is kept in one file and replaced as a whole.
    """
    spark = fact.sparkSession
    finish_staged(spark, path)
    target = read_table(spark, path)
    since = cutoff(target, lookback_days)
    recent = daily_kpis(fact, since)
    if target is not None:
        version = Window.partitionBy("event_date").orderBy(F.desc("_new"))
        recent = (
            target.withColumn("_new", F.lit(0))
            .unionByName(recent.withColumn("_new", F.lit(1)))
            .withColumn("_rank", F.row_number().over(version))
            .where("_rank = 1")
            .drop("_new", "_rank")
        )
    stage_whole(recent.repartition(1), path)
    finish_staged(spark, path)
    return since
