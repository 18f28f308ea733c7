"""Declarative constraints and the daily quality check."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.functions import columns as C
from clickmill.schemas import EVENT_TYPES, LIFECYCLE_STAGES, TIMES_OF_DAY, USER_SEGMENTS


@dataclass(frozen=True)
class Rules:
    """Constraints on the columns of one table."""

    unique: Sequence[str] = ()
    not_null: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)


# The constraints every published table must meet.
TABLE_RULES = {
    "silver": Rules(
        unique=["event_id"],
        not_null=["event_id", "user_id", "event_type", "event_timestamp"],
        accepted={"event_type": EVENT_TYPES},
    ),
    "stg_events": Rules(
        unique=["event_id"], not_null=["event_id"], accepted={"event_type": EVENT_TYPES}
    ),
    "fact_events": Rules(
        unique=["event_id"],
        not_null=["event_id", "user_id", "event_type", "event_date"],
        accepted={"event_type": EVENT_TYPES, "time_of_day": TIMES_OF_DAY},
    ),
    "dim_users": Rules(
        unique=["user_id"],
        not_null=["user_id"],
        accepted={"user_segment": USER_SEGMENTS, "lifecycle_stage": LIFECYCLE_STAGES},
    ),
    "daily_kpis": Rules(unique=["event_date"], not_null=["event_date", "dau"]),
    "funnel_analysis": Rules(not_null=["stage_order", "stage_name"]),
    "retention": Rules(unique=["cohort_week"], not_null=["cohort_week", "cohort_size"]),
}


def _long(table: str, row: DataFrame) -> DataFrame:
    """A one-row frame with columns `constraint:column` as rows."""
    parts = F.split(F.col("rule"), ":")
    return row.unpivot([], row.columns, "rule", "failures").select(
        F.lit(table).alias("table_name"),
        parts[1].alias("column_name"),
        parts[0].alias("constraint_name"),
        F.col("failures"),
    )


def check_table(table: str, df: DataFrame, rules: Rules) -> DataFrame:
    """Failures per constraint: null rows, rows outside the list, or values that occur repeatedly.

    The null and list counts are taken along while the first unique column is grouped, so that one
    scan serves them all; each further unique column is grouped on its own.
    """
    counts = [F.count_if(F.col(c).isNull()).alias(f"not_null:{c}") for c in rules.not_null] + [
        F.count_if(~F.col(c).isin(list(values))).alias(f"accepted_values:{c}")
        for c, values in rules.accepted.items()
    ]
    names = [f"not_null:{c}" for c in rules.not_null] + [f"accepted_values:{c}" for c in rules.accepted]
    frames = [] if rules.unique or not counts else [_long(table, df.agg(*counts))]
    for i, c in enumerate(rules.unique):
        beside = names if i == 0 else []
        per_value = df.groupBy(c).agg(F.count(c).alias("n"), *(counts if beside else []))
        totals = [F.coalesce(F.sum(f"`{name}`"), F.lit(0)).alias(name) for name in beside]
        frames.append(_long(table, per_value.agg(F.count_if(F.col("n") > 1).alias(f"unique:{c}"), *totals)))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def check_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All constraints of the named tables."""
    checks = [check_table(name, df, TABLE_RULES[name]) for name, df in tables.items()]
    out = checks[0]
    for check in checks[1:]:
        out = out.unionByName(check)
    return out.withColumn("passed", F.col("failures") == 0)


def _check(name: str, value: Column, level: Column | str, passed: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        value.cast("double").alias("value"),
        (F.lit(level) if isinstance(level, str) else level).alias("level"),
        passed.alias("passed"),
    )


def check_day(silver: DataFrame, day: str) -> DataFrame:
    """Row count, null ids, valid share and duplicates of one day, in one pass over that day.

    No rows on the day is a warning if other days have rows, which also skips the other checks, and
    a failure otherwise. Null ids fail, duplicates warn, the valid share is only reported. The count
    of all rows reads no column.
    """
    ids = (
        silver.where(F.col("event_date") == C.day(day))
        .groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("is_valid").alias("valid"))
    )
    counts = ids.agg(
        F.sum("n").alias("rows"),
        F.sum("valid").alias("valid"),
        F.sum(F.when(F.col("event_id").isNull(), F.col("n"))).alias("null_ids"),
        F.count("event_id").alias("ids"),
        silver.agg(F.count(F.lit(1))).scalar().alias("all_rows"),
    ).fillna(0)
    has_rows = F.col("rows") > 0
    skipped = F.when(~has_rows, "skipped")
    checks = F.array(
        _check(
            "row_count", F.col("rows"),
            F.when(has_rows, "report").when(F.col("all_rows") > 0, "warn").otherwise("fail"),
            has_rows,
        ),
        _check(
            "null_event_ids", F.col("null_ids"), F.coalesce(skipped, F.lit("fail")),
            F.col("null_ids") == 0,
        ),
        _check(
            "valid_ratio", F.when(has_rows, C.percentage("valid", "rows")),
            F.coalesce(skipped, F.lit("report")), F.lit(True),
        ),
        _check(
            "duplicate_check", F.col("rows") - F.col("ids"), F.coalesce(skipped, F.lit("warn")),
            F.col("rows") == F.col("ids"),
        ),
    )
    return counts.select(F.inline(checks))


class QualityError(ValueError):
    """A check of level `fail` did not pass."""


def enforce(checks: DataFrame) -> DataFrame:
    """Raise for failed checks of level `fail`; the frame holds one row per check."""
    failed = [r["check_name"] for r in checks.where("level = 'fail' AND NOT passed").collect()]
    if failed:
        raise QualityError(f"failed checks: {', '.join(failed)}")
    return checks
