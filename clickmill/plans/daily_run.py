"""Raw files to published tables, layer by layer. Every step can be rerun for the same input."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmill.functions.columns import checked_day
from clickmill.functions.columns import day as date_literal
from clickmill.operators import bronze, silver, user_parts
from clickmill.operators.activity import daily_sketches, weekly_estimates
from clickmill.operators.facts import fact_events, stg_events
from clickmill.operators.quality import check_day, check_tables, enforce
from clickmill.operators.retention import retention
from clickmill.plans.incremental import (
    common_ids, replace_daily, replace_daily_kpis, replace_days, replace_events, replace_user_totals, written_ids,
)
from clickmill.schemas import BRONZE, BRONZE_FILES, BRONZE_TABLE, FACT, OTHER_DAY, SILVER, SILVER_TABLE
from clickmill.sources.event_index import append_places, places_of, read_places
from clickmill.sources.folders import exists
from clickmill.sources.raw_files import is_header_mismatch, list_files, read_raw, read_raw_any
from clickmill.sources.tables import has_table, observed, read_table, replace_whole, write_days, write_table
from clickmill.sources.versions import keep_versions

CARRIED = "load_id int"  # the last load of each complete run
DAY = T.StructField("event_day", T.StringType())
WAITING = "event_id string, due timestamp_ntz"  # rows that are not valid before `due`


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, without rows before its first write."""
    table = read_table(spark, path, schema)
    return spark.createDataFrame([], schema) if table is None else table


def _plain(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table that is only added to, and never kept in versions; without rows before its first write."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


# ---- bronze: one folder per load, and a ledger of the files in it ----


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """`source_path`, `load_id`: a load counts once its files stand here."""
    return _plain(spark, f"{root}/bronze_files", BRONZE_FILES)


def last_load(spark: SparkSession, root: str) -> int:
    return read_ledger(spark, root).agg(F.coalesce(F.max("load_id"), F.lit(0))).first()[0]


def ingest(
    spark: SparkSession,
    landing: str,
    root: str,
    ingested_at: str,
    batch_id: str,
    day: str | None = None,
    force: bool = False,
    folders: str = "event_date",
) -> int:
    """Load the files that the ledger lacks (or all, with `force`); returns the rows written."""
    return load(spark, landing, root, ingested_at, batch_id, day, force, folders)[0]


def load(
    spark: SparkSession,
    landing: str,
    root: str,
    ingested_at: str,
    batch_id: str,
    day: str | None = None,
    force: bool = False,
    folders: str = "event_date",
    multi_line: bool = False,
) -> tuple[int, int]:
    """The rows that `ingest` writes, and how many of them are turned away, both counted on the way.

    Accepted and rejected rows are told apart by `reject_reason`, so that each file is parsed once.
    Every load has a folder of its own, whatever its batch id: it never touches the rows of other
    files. It counts from the moment its files are in the ledger; a load that stopped before is
    overwritten by the next. A file that is loaded again supersedes its former rows, and no others.
    Within a load rows lie by checked day; wrong dates share one partition. The places of the accepted
    rows go into the event index before the load counts.
    """
    found = list_files(spark, landing, day, folders).withColumn("is_new", F.lit(True))
    if not force:
        done = read_ledger(spark, root).select("source_path", F.lit(False).alias("is_new")).distinct()
        found = found.drop("is_new").join(done, "source_path", "left").withColumn("is_new", F.col("is_new").isNull())
    write_table(found.select("path", "source_path", "is_new"), f"{root}/listed_files")  # as listed now, not later
    listed = spark.read.schema("path string, source_path string, is_new boolean").parquet(f"{root}/listed_files")
    files, new = listed.agg(F.count(F.lit(1)), F.count_if("is_new")).first()
    if not new:
        return 0, 0
    todo = listed.where("is_new").select("path", "source_path")
    load_id = last_load(spark, root) + 1
    names = todo.select("source_path", F.lit(load_id).alias("load_id"))
    every = new == files  # then the folders name them: no list of names passes through the driver
    paths = [f"{landing.rstrip('/')}/{folders}={day or '*'}"] if every else [r["path"] for r in todo.select("path").collect()]

    def only_listed(raw: DataFrame) -> DataFrame:
        """Without files that arrived since the listing."""
        return raw.join(todo.select("source_path"), "source_path", "left_semi") if every else raw

    def put(raw: DataFrame) -> tuple[int, int]:
        return write_load(only_listed(raw), root, load_id, ingested_at, batch_id)

    try:
        counts = put(read_raw(spark, paths, multi_line=multi_line))
    except Exception as error:
        if not is_header_mismatch(error):
            raise
        counts = put(read_raw_any(spark, paths, multi_line))  # some file has other columns: look at each header
    record_load(spark, root, load_id, names)
    return counts


def write_load(raw: DataFrame, root: str, load_id: int, ingested_at: str, batch_id: str) -> tuple[int, int]:
    """The rows of one load in their folder; returns how many, and how many of them are turned away."""
    seen = Observation()
    rows = bronze.typed_rows(raw, ingested_at, batch_id).withColumn(
        "event_day", checked_day("event_date", F.col("ingested_at"))
    )
    turned_away = F.count_if(F.col("reject_reason") != "").alias("rejected")
    written = write_days(
        rows.observe(seen, turned_away), f"{root}/bronze/load_id={load_id}", keys=("event_day",),
        sort=("event_date",), replace="all",
    )
    return written, observed(seen, "rejected")["rejected"]


def record_load(spark: SparkSession, root: str, load_id: int, names: DataFrame) -> None:
    """Add the places of a written load to the event index, then its files to the ledger: now it counts."""
    index = f"{root}/event_index"
    if load_id == 1 or read_places(spark, index) is not None:
        new = _plain(spark, f"{root}/bronze/load_id={load_id}", T.StructType([*BRONZE_TABLE.fields[:-2], DAY]))
        append_places(spark, index, new.where("reject_reason = ''"))
    else:  # tables from before there was an index
        append_places(spark, index, _plain(spark, f"{root}/bronze", BRONZE_TABLE).where("reject_reason = ''"))
    names.repartition(1).write.mode("append").parquet(f"{root}/bronze_files")  # one file: all or none


def load_batch(
    spark: SparkSession, raw: DataFrame, root: str, stream: str, batch: int, ingested_at: str
) -> tuple[int, int]:
    """One micro-batch of a stream as a load, once: the ledger keeps a line for it beside its files, in the
    same write, so that a batch that the stream repeats is not loaded again."""
    line = f"{stream}/batch {batch}"
    ledger = read_ledger(spark, root)
    if not ledger.where(F.col("source_path") == line).isEmpty():
        return 0, 0
    load_id = last_load(spark, root) + 1
    counts = write_load(raw, root, load_id, ingested_at, line)
    stored = _plain(spark, f"{root}/bronze/load_id={load_id}", T.StructType([*BRONZE_TABLE.fields[:-2], DAY]))
    mark = spark.createDataFrame([(line, load_id)], BRONZE_FILES)
    files = stored.select("source_path", F.lit(load_id).alias("load_id")).distinct()
    record_load(spark, root, load_id, mark.union(files))
    return counts


def _loaded_rows(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all loads that count, superseded ones included."""
    rows = _plain(spark, f"{root}/bronze", BRONZE_TABLE)
    return rows.where(F.col("load_id") <= last_load(spark, root))


def read_rows(spark: SparkSession, root: str) -> DataFrame:
    """The rows of each file's latest load, accepted or not, with `load_id` and `event_day`."""
    rows, ledger = _loaded_rows(spark, root), read_ledger(spark, root)
    latest = Window.partitionBy("source_path").orderBy(F.desc("load_id"))
    former = ledger.withColumn("version", F.row_number().over(latest)).where("version > 1").drop("version")
    if former.isEmpty():  # the rule: no file was loaded twice
        return rows
    return rows.join(former, ["source_path", "load_id"], "left_anti").select(rows.columns)


def read_bronze(spark: SparkSession, root: str, day: str | None = None) -> DataFrame:
    """Accepted rows, of one day if given: only that day's partitions and those of wrong dates."""
    rows = read_rows(spark, root)
    if day:
        rows = rows.where(F.col("event_day").isin(day, OTHER_DAY) & (F.col("event_date") == date_literal(day)))
    return bronze.accepted(rows)


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    return bronze.rejected(read_rows(spark, root))


# ---- what a load changes, carried through the layers ----


@dataclass(frozen=True)
class Change:
    """Loads not yet carried through, those after `done` up to `last`: the event ids in them and the places of
    these ids' rows.

    Without `ids` everything is new. `partitions` are silver's, `days` the fact's. `former` are those of the ids
    that loads up to `done` have rows of, which are few as a rule.
    """

    last: int
    ids: DataFrame | None
    partitions: list[str]
    days: list[date] | None
    done: int = 0
    former: DataFrame | None = None


def pending(spark: SparkSession, root: str, now: str) -> Change | None:
    """The change that loads since the last complete run make, and rows whose time has come since then;
    None without either.

    An id's rows may lie on several days, in older loads too, so the places are looked up in the event
    index. As it keeps the places of superseded rows, they include every day that a former run can have
    written a row of these ids to: a run that stopped half-way is simply repeated. `now` must not go back
    between runs.
    """
    last = last_load(spark, root)
    done = _plain(spark, f"{root}/carried", CARRIED).agg(F.coalesce(F.max("load_id"), F.lit(0))).first()[0]
    due = read_waiting(spark, root).where(F.col("due") <= F.lit(now).cast("timestamp_ntz")).select("event_id")
    if last == done and due.isEmpty():
        return None
    if done == 0 and not has_table(spark, f"{root}/silver"):
        return Change(last, None, [], None)
    ledger, rows = read_ledger(spark, root), _loaded_rows(spark, root).where("reject_reason = ''")
    files = ledger.where(F.col("load_id") > done).select("source_path").distinct()
    loads = ledger.join(files, "source_path", "left_semi").select("load_id").distinct().collect()  # runs
    touched = rows.where(F.col("load_id").isin([r[0] for r in loads])).join(files, "source_path", "left_semi")
    write_table(touched.select("event_id").union(due).distinct(), f"{root}/changed_ids")
    ids = spark.read.schema("event_id string").parquet(f"{root}/changed_ids")
    in_range = checked_day("event_date", now) != OTHER_DAY
    places = (
        places_of(spark, f"{root}/event_index", ids)
        .select("event_day", F.when(in_range, F.col("event_date")).alias("day"))
        .distinct()
        .collect()  # calendar days since 2020, twice at most
    )
    partitions = sorted({p[0] for p in places})
    known = rows.where((F.col("load_id") <= done) & F.col("event_day").isin(partitions))
    former = written_ids(common_ids(known, ids), f"{root}/former_ids")
    return Change(last, ids, partitions, sorted({p[1] for p in places if p[1]}), done, former)


def _rows_of(rows: DataFrame, change: Change) -> DataFrame:
    """Bronze rows of the changed ids, from the partitions that hold any: all rows of the pending loads, and those
    of former loads that have one of these ids. Only the latter are joined, with as few ids as there can be."""
    if change.ids is None:
        return rows
    rows = rows.where(F.col("event_day").isin(change.partitions))
    former = rows.where(F.col("load_id") <= change.done).join(change.former, "event_id", "left_semi")
    return rows.where(F.col("load_id").between(change.done + 1, change.last)).unionByName(former)


def clean_rows(spark: SparkSession, root: str, now: str, change: Change) -> DataFrame:
    """The one row of each changed id, cleaned, chosen among all rows of that id on any day."""
    rows = _rows_of(read_rows(spark, root).where("reject_reason = ''"), change)
    return silver.clean(rows.select(*BRONZE.fieldNames(), "event_day"), now, also=["event_day"])


def read_waiting(spark: SparkSession, root: str) -> DataFrame:
    """Ids whose row lies after the last run's `now`, and when it is due."""
    return _read(spark, f"{root}/waiting", T.StructType.fromDDL(WAITING))


def build_silver(spark: SparkSession, root: str, now: str, change: Change) -> dict[str, int]:
    """Replace the rows of the changed ids, unique across days. Invalid rows are kept and flagged.

    A few changed rows are written once for all layers. Rows dated after `now` go onto a waiting list,
    which every run checks against its own `now`. Returns the changed `rows` and how many are `invalid`.
    """
    rows = clean_rows(spark, root, now, change)
    if change.ids is not None:
        write_table(rows, f"{root}/changed_rows")
        rows = spark.read.schema(SILVER_TABLE).parquet(f"{root}/changed_rows")
    counts = replace_events(
        rows, f"{root}/silver", change.ids, change.partitions, sort=("is_valid", "user_id"), key="event_day",
        counts={"invalid": F.count_if(~F.col("is_valid"))},
    )
    due = F.greatest("event_timestamp", F.col("event_date").cast("timestamp_ntz"))
    later = changed_silver(spark, root, change).where(~F.col("is_valid")).select("event_id", due.alias("due"))
    later = later.where(F.col("due") > F.lit(now).cast("timestamp_ntz"))
    if change.ids is not None:
        later = later.unionByName(read_waiting(spark, root).join(change.ids, "event_id", "left_anti"))
    replace_whole(later, f"{root}/waiting")
    return counts


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/silver", SILVER_TABLE).select(SILVER.fieldNames())


def changed_silver(spark: SparkSession, root: str, change: Change) -> DataFrame:
    if change.ids is None:
        return read_silver(spark, root)
    return _plain(spark, f"{root}/changed_rows", SILVER_TABLE).select(SILVER.fieldNames())


def changed_users(spark: SparkSession, root: str, change: Change) -> DataFrame | None:
    """Users that any row of the changed ids ever named, so that one who lost a row is among them, too."""
    if change.ids is None:
        return None
    rows = _rows_of(_loaded_rows(spark, root).where("reject_reason = ''"), change)
    write_table(rows.select("user_id").distinct(), f"{root}/changed_users")
    return spark.read.schema("user_id string").parquet(f"{root}/changed_users")


def build_marts(spark: SparkSession, root: str, as_of: str, change: Change) -> None:
    """Fact, user-days and daily figures of the changed ids and days, totals of the changed users; the other
    tables are made of these.

    Nothing is built while there are no valid rows.
    """
    changed = stg_events(changed_silver(spark, root, change))
    if not has_table(spark, f"{root}/fact_events") and stg_events(read_silver(spark, root)).isEmpty():
        return
    days = change.days
    replace_events(fact_events(changed), f"{root}/fact_events", change.ids, days or [])
    if not has_table(spark, f"{root}/user_values"):  # tables from before there were parts
        days = None
    fact = _read(spark, f"{root}/fact_events", FACT)
    if days is not None:
        fact = fact.where(F.col("event_date").isin(days))
    replace_days(user_parts.user_days(fact), f"{root}/user_days", days)
    replace_days(user_parts.user_values(fact), f"{root}/user_values", days)
    replace_daily(lambda only: daily_sketches(fact), spark, f"{root}/day_sketches", days)
    by_day, values = (read_table(spark, f"{root}/{name}") for name in ("user_days", "user_values"))
    replace_daily_kpis(
        lambda only: user_parts.daily_kpis(by_day, values, only), spark, f"{root}/daily_kpis", days
    )
    users = changed_users(spark, root, change) if days is not None else None
    replace_user_totals(by_day, values, f"{root}/user_totals", users)
    totals = read_table(spark, f"{root}/user_totals")
    replace_whole(user_parts.dim_users(totals, as_of), f"{root}/dim_users")
    replace_whole(user_parts.funnel_analysis(totals), f"{root}/funnel_analysis")
    replace_whole(retention(by_day.select("user_id", "event_date")), f"{root}/retention")


def read_weekly_estimates(spark: SparkSession, root: str) -> DataFrame:
    """Weekly users of each day within the sketches' tolerance, from one stored sketch a day."""
    return weekly_estimates(read_table(spark, f"{root}/day_sketches"))


MART_ORDER = {
    "daily_kpis": ["event_date"],
    "funnel_analysis": ["stage_order"],
    "retention": ["cohort_week"],
    "dim_users": [],
}


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A published table in the order its reports show it."""
    table = read_table(spark, f"{root}/{name}")
    return table.orderBy(*MART_ORDER[name]) if MART_ORDER[name] else table


def check(spark: SparkSession, root: str, day: str) -> DataFrame:
    """Daily check of silver (raises on failure), then all table constraints."""
    cleaned = read_silver(spark, root)
    enforce(check_day(cleaned, day))
    valid = silver.valid(cleaned)
    names = ["fact_events", "dim_users", "daily_kpis", "funnel_analysis", "retention"]
    tables = {name: read_table(spark, f"{root}/{name}") for name in names}
    return check_tables({"silver": valid, "stg_events": stg_events(valid), **tables})


def run(
    spark: SparkSession,
    landing: str,
    root: str,
    now: str,
    as_of: str,
    batch_id: str,
    day: str | None = None,
    force: bool = False,
    folders: str = "event_date",
    versioned: bool = False,
    multi_line: bool = False,
) -> dict[str, int]:
    """Load one day's files or all that arrived, and carry every change they make through all layers.

    With `versioned`, the first run decides that the tables of `root` are kept in versions; they are then
    read by `read_table`, which gives readers one whole version at any time. `multi_line` takes line breaks in
    quoted cells, at the price of one task per file. Returns the rows of the load (`bronze`), how many of them were `rejected`, the rows of the changed
    ids in `silver`, and how many of those are `invalid`.
    """
    if versioned and not exists(spark, f"{root}/bronze"):
        keep_versions(spark, root)
    written, rejected = load(spark, landing, root, now, batch_id, day, force, folders, multi_line)
    return {"bronze": written, "rejected": rejected, **carry(spark, root, now, as_of)}


def carry(spark: SparkSession, root: str, now: str, as_of: str) -> dict[str, int]:
    """Carry what loads and the passing of time have changed through all layers."""
    counts = {"silver": 0, "invalid": 0}
    change = pending(spark, root, now)
    if change:
        found = build_silver(spark, root, now, change)
        counts |= {"silver": found["rows"], "invalid": found["invalid"]}
        build_marts(spark, root, as_of, change)
        carried = spark.createDataFrame([(change.last,)], CARRIED)
        carried.repartition(1).write.mode("append").parquet(f"{root}/carried")
    return counts
