"""The registered queries: every operator on frames derived from the star-schema tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.functions import columns as C
from clickmill.functions.calendar import date_spine
from clickmill.operators import activity, bronze, facts, funnel, kpis, quality, reports, silver, users
from clickmill.operators import retention as cohorts
from clickmill.plans import daily_run, incremental
from clickmill.schemas import BRONZE, BRONZE_ROWS, FACT, RAW
from clickmill.session import scratch_folder
from clickmill.sources import sample_events as sample
from clickmill.streaming import file_stream

Query = Callable[[SparkSession, str], DataFrame]

NOW, AS_OF = sample.NOW, sample.AS_OF
CHECK_DAY = "2024-02-15"  # the day of the single-day run and of the daily check
CLOSE = 0.08  # of the exact count: five standard errors of a sketch with 4096 registers
FIRST_DROP = "2024-02-20"  # last day of the first of two deliveries
EARLY = "2024-02-10 00:00:00"  # the first of two runs over the same files
REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    def published(spark: SparkSession, sf_dir: str) -> DataFrame:
        return publish(run(spark, sf_dir))

    REGISTRY[run.__name__] = published
    return published


def publish(df: DataFrame) -> DataFrame:
    """Decimals as doubles, as in the exchange format of the results."""
    money = [name for name, kind in df.dtypes if kind.startswith("decimal")]
    return df.withColumns({c: F.col(c).cast("double") for c in money}) if money else df


# ---- input frames ----


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.raw_text(spark, sf_dir).drop("file_date")


def _bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.typed_rows(_raw(spark, sf_dir), NOW, "batch_1")


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.dirty_events(spark, sf_dir).select(RAW.fieldNames())


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean(_dirty(spark, sf_dir), NOW)


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dirty rows with flags, copies included."""
    return silver.flag_rows(_dirty(spark, sf_dir), NOW)


def _stg(spark: SparkSession, sf_dir: str, product: bool = True, place: bool = True) -> DataFrame:
    """Staged events without faults: unique ids, all of them valid."""
    flags = {"is_valid": F.lit(True), "quality_flags": F.lit("")}
    events = sample.clean_events(spark, sf_dir, product, place)
    rows = events.select(RAW.fieldNames()).withColumns(flags)
    return facts.stg_events(silver.add_derived(rows, NOW))


def _fact(spark: SparkSession, sf_dir: str, product: bool = True, place: bool = True) -> DataFrame:
    return facts.fact_events(_stg(spark, sf_dir, product, place))


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact for queries on users, days and event types alone."""
    return _fact(spark, sf_dir, product=False, place=False)


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact for queries that need amounts but no places."""
    return _fact(spark, sf_dir, place=False)


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.user_days(_visits(spark, sf_dir))


def _kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.daily_kpis(_sales(spark, sf_dir))


def _retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohorts.retention(_days(spark, sf_dir))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users.dim_users(_stg(spark, sf_dir), AS_OF)


# ---- bronze and silver ----


@query
def bronze_ingest(spark, sf_dir):
    return bronze.accepted(_bronze_rows(spark, sf_dir))


@query
def bronze_rejects(spark, sf_dir):
    return bronze.reject_counts(_bronze_rows(spark, sf_dir))


def _deliver(text: DataFrame, landing: str) -> None:
    """Add raw text as CSV files in one folder per delivery day; the rows keep their own date."""
    (
        text.select(*RAW.fieldNames(), F.col("file_date").alias("delivered"))
        .hint("rebalance", "delivered")
        .write.mode("append")
        .options(header="true", escape='"')
        .partitionBy("delivered")
        .csv(landing)
    )


def _deliveries(text: DataFrame, first: Column, folder: str) -> list[DataFrame]:
    """The rows for which `first` holds, and those for which it does not, from one pass over the events.

    The text is written once and marked. A filter on each part would derive all rows twice,
    and the optimizer would move it down to the scan, where it repeats the derivation of a row's day many times
    over, in code that is too long for the JVM to compile.
    """
    text.withColumn("is_first", first).write.parquet(f"{folder}/sent")
    sent = text.sparkSession.read.parquet(f"{folder}/sent")
    return [sent.where(part).drop("is_first") for part in (F.col("is_first"), ~F.col("is_first"))]


@query
def bronze_incremental_files(spark, sf_dir):
    """Two deliveries and two loads; the second load takes only the files of the second delivery."""
    folder = scratch_folder(spark, "bronze_incremental_files")
    text, first = sample.raw_text(spark, sf_dir), F.col("file_date") <= C.day(FIRST_DROP)
    for number, part in enumerate(_deliveries(text, first, folder), 1):
        batch = f"batch_{number}"
        _deliver(part, f"{folder}/landing")
        daily_run.ingest(spark, f"{folder}/landing", folder, NOW, batch, folders="delivered")
    return daily_run.read_bronze(spark, folder).drop("source_file")


@query
def bronze_malformed_lines(spark, sf_dir):
    """Files in which some lines have cells too many, end early, or break within a quoted cell: rows by what
    is wrong with their line, and whether they are accepted."""
    folder = scratch_folder(spark, "bronze_malformed_lines")
    text = sample.malformed_lines(sample.raw_text(spark, sf_dir).drop("file_date"))
    text.write.options(header="true", quote="\x02", sep="\x01").csv(f"{folder}/landing/event_date=2024-03-25")
    daily_run.load(spark, f"{folder}/landing", folder, NOW, "batch_1")
    fault = F.regexp_extract("reject_reason", "(extra_cells|open_quote)$", 1).alias("fault")
    rows = daily_run.read_rows(spark, folder).select(fault, (F.col("reject_reason") == "").alias("accepted"))
    return rows.groupBy("fault", "accepted").agg(F.count(F.lit(1)).alias("rows"))


@query
def bronze_time_formats(spark, sf_dir):
    """Times spelled in five ways, one of which may leave month and day open."""
    rows = bronze.typed_rows(sample.spelled_times(spark, sf_dir), NOW, "batch_1")
    return rows.select("event_id", "event_timestamp", "event_date", "reject_reason").distinct()


@query
def dedup_events(spark, sf_dir):
    return silver.dedup_events(_dirty(spark, sf_dir))


@query
def silver_flags(spark, sf_dir):
    return _flagged(spark, sf_dir).select(
        "event_id", "user_id", "event_type", "event_timestamp", "is_valid", "quality_flags"
    )


@query
def silver_price_repair(spark, sf_dir):
    repaired = silver.repair_prices(_dirty(spark, sf_dir))
    return repaired.select("event_id", "event_type", "product_price")


@query
def silver_clean(spark, sf_dir):
    return silver.valid(_silver(spark, sf_dir))


@query
def silver_quarantine(spark, sf_dir):
    return silver.quarantined(_silver(spark, sf_dir))


@query
def silver_single_day(spark, sf_dir):
    """One day of the dirty events, cleaned on its own."""
    one_day = _dirty(spark, sf_dir).where(F.col("event_date") == C.day(CHECK_DAY))
    return silver.valid(silver.clean(one_day, NOW))


# ---- marts ----


@query
def stg_events(spark, sf_dir):
    return facts.stg_events(_silver(spark, sf_dir))


@query
def fact_events(spark, sf_dir):
    return facts.fact_events(facts.stg_events(_silver(spark, sf_dir)))


@query
def time_of_day_mix(spark, sf_dir):
    return (
        _sales(spark, sf_dir)
        .groupBy("time_of_day", "is_weekend")
        .agg(F.count(F.lit(1)).alias("events"), F.count_if("is_revenue_event").alias("revenue_events"))
    )


@query
def dim_users(spark, sf_dir):
    return _users(spark, sf_dir)


@query
def user_modes(spark, sf_dir):
    return users.user_modes(_stg(spark, sf_dir, product=False))


@query
def daily_kpis(spark, sf_dir):
    return _kpis(spark, sf_dir)


@query
def wau_rolling(spark, sf_dir):
    return activity.rolling_active_users(_days(spark, sf_dir))


@query
def wau_approx(spark, sf_dir):
    """The exact weekly users, and whether the sketches come within `CLOSE` of them."""
    estimate = activity.rolling_active_users_approx(_visits(spark, sf_dir)).withColumnRenamed("wau", "estimate")
    exact = activity.rolling_active_users(_days(spark, sf_dir))
    return exact.join(estimate, "event_date", "left").select(
        "event_date",
        "wau",
        F.coalesce(F.abs(F.col("estimate") - F.col("wau")) <= CLOSE * F.col("wau"), F.lit(False)).alias(
            "estimate_is_close"
        ),
    )


@query
def funnel_analysis(spark, sf_dir):
    return funnel.funnel_analysis(_visits(spark, sf_dir))


@query
def cohort_activity(spark, sf_dir):
    return activity.cohort_activity(_days(spark, sf_dir))


@query
def retention(spark, sf_dir):
    return _retention(spark, sf_dir)


@query
def retention_flags(spark, sf_dir):
    return cohorts.retention_flags(_days(spark, sf_dir))


# ---- incremental tables ----


@query
def fact_incremental(spark, sf_dir):
    """A first full run, a late delivery within the look-back, and a rerun of the same input."""
    path = scratch_folder(spark, "fact_incremental") + "/fact_events"
    fact = _fact(spark, sf_dir)
    incremental.upsert_facts(fact.where(F.col("event_date") <= C.day(FIRST_DROP)), path)
    incremental.upsert_facts(fact, path)
    incremental.upsert_facts(fact, path)
    return spark.read.parquet(path).select(fact.columns)


@query
def daily_kpis_incremental(spark, sf_dir):
    path = scratch_folder(spark, "daily_kpis_incremental") + "/daily_kpis"
    fact = _sales(spark, sf_dir)
    incremental.update_daily_kpis(fact.where(F.col("event_date") <= C.day(FIRST_DROP)), path)
    incremental.update_daily_kpis(fact, path)
    return spark.read.parquet(path)


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text in which some rows have a day far off."""
    far = F.substring("event_id", 2, 20).cast("long") % 113 == 0
    day = F.when(far, "9999-12-31").otherwise(F.col("event_date"))
    return sample.raw_text(spark, sf_dir).withColumn("event_date", day)


def _run_by_day(spark: SparkSession, sf_dir: str, folder: str, versioned: bool = False) -> None:
    """Two deliveries and runs. Folders hold rows of other days, some ids lie on two days, and some
    rows have a day far off; the second delivery also brings late rows to all the earlier days."""
    text = _arriving(spark, sf_dir)
    late = F.crc32(F.concat_ws(" ", "event_id", "event_timestamp")) % 5 == 0
    first = (F.col("file_date") <= C.day(FIRST_DROP)) & ~late
    sent, rest = _deliveries(text, first, folder)
    second = rest.withColumn("file_date", F.date_add("file_date", F.when(late, 1).otherwise(0)))
    for part in (sent, second):
        _deliver(part, f"{folder}/landing")
        daily_run.run(
            spark, f"{folder}/landing", f"{folder}/tables", NOW, AS_OF, "same", folders="delivered", versioned=versioned
        )


@query
def daily_run_by_day(spark, sf_dir):
    """The fact after several runs of the whole job: the same as after one."""
    folder = scratch_folder(spark, "daily_run_by_day")
    _run_by_day(spark, sf_dir, folder)
    return spark.read.parquet(f"{folder}/tables/fact_events").select(FACT.fieldNames())


@query
def daily_kpis_by_day(spark, sf_dir):
    folder = scratch_folder(spark, "daily_kpis_by_day")
    _run_by_day(spark, sf_dir, folder)
    return spark.read.parquet(f"{folder}/tables/daily_kpis")


@query
def users_by_day(spark, sf_dir):
    """The user dimension after two deliveries, of which the second merges the users it touches alone; from
    tables in versions."""
    folder = scratch_folder(spark, "users_by_day")
    _run_by_day(spark, sf_dir, folder, versioned=True)
    return daily_run.read_mart(spark, f"{folder}/tables", "dim_users")


@query
def weekly_estimates_by_day(spark, sf_dir):
    """Weekly users after two deliveries from the stored user-days, and whether the stored sketches, one a
    day, come within `CLOSE` of them."""
    folder = scratch_folder(spark, "weekly_estimates_by_day")
    _run_by_day(spark, sf_dir, folder)
    tables = f"{folder}/tables"
    exact = spark.read.parquet(f"{tables}/daily_kpis").select("event_date", "wau")
    estimate = daily_run.read_weekly_estimates(spark, tables).withColumnRenamed("wau", "estimate")
    close = F.abs(F.col("estimate") - F.col("wau")) <= CLOSE * F.col("wau")
    return exact.join(estimate, "event_date", "left").select(
        "event_date", "wau", F.coalesce(close, F.lit(False)).alias("estimate_is_close")
    )


@query
def future_rows_by_run(spark, sf_dir):
    """The fact after a run at an early `now`, which finds later rows not valid yet, and one without new
    files at the usual `now`: the same as after one run then."""
    folder = scratch_folder(spark, "future_rows_by_run")
    _deliver(_arriving(spark, sf_dir), f"{folder}/landing")
    for now in (EARLY, NOW):
        daily_run.run(
            spark, f"{folder}/landing", f"{folder}/tables", now, AS_OF, "same", folders="delivered"
        )
    return spark.read.parquet(f"{folder}/tables/fact_events").select(FACT.fieldNames())


# ---- utilities ----


@query
def date_utils(spark, sf_dir):
    """The calendar helpers on every day between the first and the last event."""
    first, last = F.min("event_date").alias("first"), F.max("event_date").alias("last")
    spine = (
        _visits(spark, sf_dir)
        .agg(first, last)
        .select("first", F.explode(F.sequence("first", "last")).alias("date_day"))
    )
    return spine.select(
        "date_day",
        C.start_of_week("date_day").alias("week_start"),
        C.start_of_month("date_day").alias("month_start"),
        C.days_between("first", "date_day").alias("days_since_first"),
        C.day_of_week("date_day").alias("day_of_week"),
        C.is_weekend("date_day").alias("is_weekend"),
        C.day_name("date_day").alias("day_name"),
        C.safe_divide(C.days_between("first", "date_day"), C.day_of_week("date_day"), 3).alias("ratio"),
    )


@query
def date_spine_kpis(spark, sf_dir):
    """Daily figures from 2024-01-01 to `AS_OF`, days without events included."""
    return reports.date_spine_kpis(_kpis(spark, sf_dir), date_spine(spark, "2024-01-01", AS_OF))


@query
def event_type_dimension(spark, sf_dir):
    return facts.by_event_type(_sales(spark, sf_dir), facts.event_types(spark))


# ---- quality ----


@query
def dq_constraints(spark, sf_dir):
    """Constraints on the flagged dirty rows, which break some, and on the marts, which keep all."""
    fact = _fact(spark, sf_dir)
    return quality.check_tables(
        {
            "silver": _flagged(spark, sf_dir),
            "stg_events": _stg(spark, sf_dir),
            "fact_events": fact,
            "dim_users": _users(spark, sf_dir),
            "daily_kpis": kpis.daily_kpis(fact),
            "funnel_analysis": funnel.funnel_analysis(fact),
            "retention": _retention(spark, sf_dir),
        }
    )


@query
def dq_checks(spark, sf_dir):
    flagged = _flagged(spark, sf_dir)
    return quality.check_day(flagged, CHECK_DAY)


# ---- reports ----


@query
def kpi_cards(spark, sf_dir):
    return reports.kpi_cards(_kpis(spark, sf_dir))


@query
def kpi_trends(spark, sf_dir):
    return reports.kpi_trends(_kpis(spark, sf_dir))


@query
def funnel_report(spark, sf_dir):
    return reports.funnel_report(funnel.funnel_analysis(_visits(spark, sf_dir)))


@query
def retention_heatmap(spark, sf_dir):
    return reports.retention_heatmap(_retention(spark, sf_dir))


@query
def cohort_sizes(spark, sf_dir):
    return reports.cohort_sizes(_retention(spark, sf_dir))


@query
def user_segments(spark, sf_dir):
    return reports.user_segments(_users(spark, sf_dir))


@query
def lifecycle_stages(spark, sf_dir):
    return reports.lifecycle_stages(_users(spark, sf_dir))


@query
def user_summary(spark, sf_dir):
    return reports.user_summary(_users(spark, sf_dir))


@query
def revenue_histogram(spark, sf_dir):
    return reports.revenue_histogram(_users(spark, sf_dir))


@query
def event_distribution(spark, sf_dir):
    return reports.event_distribution(_visits(spark, sf_dir))


@query
def event_totals(spark, sf_dir):
    return reports.event_totals(reports.event_distribution(_visits(spark, sf_dir)))


@query
def device_breakdown(spark, sf_dir):
    return reports.device_breakdown(_kpis(spark, sf_dir))


# ---- streaming ----


@query
def stream_bronze(spark, sf_dir):
    """Files read as a stream, in two deliveries; the second run reads only the new files."""
    folder = scratch_folder(spark, "stream_bronze")
    text, first = sample.raw_text(spark, sf_dir), F.col("file_date") <= C.day(FIRST_DROP)
    for number, part in enumerate(_deliveries(text, first, folder), 1):
        batch = f"batch_{number}"
        _deliver(part, f"{folder}/landing")
        rows = file_stream.bronze_stream(file_stream.raw_stream(spark, f"{folder}/landing"), batch)
        file_stream.write_available(rows, f"{folder}/bronze", f"{folder}/checkpoint")
    rows = spark.read.schema(BRONZE_ROWS).parquet(f"{folder}/bronze")
    return bronze.accepted(rows).select(*[c for c in BRONZE.fieldNames() if c not in ("source_file", "ingested_at")])


def _land(text: DataFrame, landing: str) -> None:
    """Add raw text as CSV files of full size in one folder: as many tasks write as the rows ask for."""
    rows = text.select(RAW.fieldNames()).hint("rebalance")
    rows.write.mode("append").options(header="true", escape='"').csv(landing)


@query
def stream_fact(spark, sf_dir):
    """The fact of a stream whose micro-batches are carried into the daily job's tables, in two deliveries,
    the second with copies of earlier ids: the same as that of one run over all files."""
    folder = scratch_folder(spark, "stream_fact")
    text = _arriving(spark, sf_dir)
    late = F.crc32(F.concat_ws(" ", "event_id", "event_timestamp")) % 5 == 0
    for part in _deliveries(text, ~late, folder):
        _land(part, f"{folder}/landing")
        file_stream.publish_available(
            spark, f"{folder}/landing", f"{folder}/tables", f"{folder}/checkpoint", NOW, AS_OF
        )
    return spark.read.parquet(f"{folder}/tables/fact_events").select(FACT.fieldNames())


@query
def stream_dedup(spark, sf_dir):
    """The dirty events read as a stream, each id kept once."""
    folder = scratch_folder(spark, "stream_dedup")
    rows = _dirty(spark, sf_dir)
    rows.write.parquet(f"{folder}/events")
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/events")
    file_stream.write_available(
        file_stream.dedup_stream(stream), f"{folder}/unique", f"{folder}/checkpoint"
    )
    unique = spark.read.schema(rows.schema).parquet(f"{folder}/unique")
    return unique.select("event_id", "user_id", "event_type", "product_id", "session_id", "device_type")
