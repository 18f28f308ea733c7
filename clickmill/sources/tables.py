"""Parquet tables laid out by day, rewritten by whole partitions so that every run can be repeated.

Tables right under a folder with a `_versioned` mark are kept in versions (see `versions`): readers never
meet a table half-way, and nothing is renamed. Others are one folder each, replaced by rename.
"""

from collections.abc import Sequence
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmill.sources.folders import (
    children, drop, exists, hadoop_path, require_marker, write_partitions,
)
from clickmill.sources.versions import (
    current, drop_version, is_versioned, publish_staged, read_version, stage_version,
)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another.

    The old one is set aside, under a name that readers skip, and deleted last: nothing is lost if the
    job stops in between, and readers miss it for two renames only.
    """
    old, fs = hadoop_path(spark, source)
    new, _ = hadoop_path(spark, target)
    aside, _ = hadoop_path(spark, f"{new.getParent()}/.former-{new.getName()}")
    fs.mkdirs(new.getParent())
    if fs.exists(new):
        fs.delete(aside, True)
        if not fs.rename(new, aside):
            raise OSError(f"could not set {target} aside")
    if not fs.rename(old, new):
        raise OSError(f"could not move {source} to {target}")
    fs.delete(aside, True)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The table, or None before its first write."""
    if is_versioned(spark, path):
        return read_version(spark, path, schema)
    if not exists(spark, path):
        return None
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without data files
            return None
        raise


def has_table(spark: SparkSession, path: str) -> bool:
    return current(spark, path) is not None if is_versioned(spark, path) else exists(spark, path)


def write_days(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = ("event_date",),
    sort: Sequence[str] = (),
    replace: str = "partitions",
) -> int:
    """Replace the partitions that `df` holds rows for (or the whole table); returns the row count.

    Rebalancing by day makes full-size files and lets adaptive execution split a day that is much
    larger than the rest. Rows are counted as they are written, without a second job; tasks repeated
    after a lost executor may count twice.
    """
    written = Observation()
    write_partitions(df.observe(written, F.count(F.lit(1)).alias("rows")), path, keys, sort, replace)
    return observed(written, "rows")["rows"]


def observed(seen: Observation, *names: str) -> dict[str, int]:
    """The counts taken while rows were written; all 0 where adaptive execution found, at run time, that
    there was no row to look at, and left the observing step out."""
    try:
        return dict(seen.get)
    except Py4JJavaError:
        return dict.fromkeys(names, 0)


def _staged(path: str) -> str:
    return f"{path.rstrip('/')}__staged"


def stage(
    df: DataFrame,
    path: str,
    touched: Sequence[date | str] = (),
    sort: Sequence[str] = (),
    key: str = "event_date",
) -> None:
    """Write new versions of days next to the table; `finish_staged` moves them in.

    A job must not overwrite what it reads. The staged write counts once it is complete, and a run
    that stopped in between is finished by the next one. `touched` lists the days to replace, for
    those that end up without rows. `key` is the partition column.
    """
    spark, folder = df.sparkSession, _staged(path)
    if is_versioned(spark, path):
        stage_version(df, path, [str(d) for d in touched], sort, key)
        return
    drop(spark, folder)
    if touched:
        names = spark.createDataFrame([(f"{key}={d}",) for d in touched], "name string")
        write_table(names, f"{folder}/touched")
    write_partitions(df, f"{folder}/rows", (key,), sort, "all")
    require_marker(spark, f"{folder}/rows")


def stage_whole(df: DataFrame, path: str) -> None:
    """Write a new version of a small table, kept in one folder, next to the old one."""
    folder = _staged(path)
    if is_versioned(df.sparkSession, path):
        stage_version(df, path)
        return
    drop(df.sparkSession, folder)
    write_table(df, f"{folder}/rows")
    require_marker(df.sparkSession, f"{folder}/rows")


def replace_whole(df: DataFrame, path: str) -> None:
    """Full rebuild that leaves the old table in place until the new one is complete."""
    finish_staged(df.sparkSession, path)
    stage_whole(df, path)
    finish_staged(df.sparkSession, path)


def drop_staged(spark: SparkSession, path: str) -> None:
    """Give up a staged write; the table stays as it is."""
    drop_version(spark, path) if is_versioned(spark, path) else drop(spark, _staged(path))


def finish_staged(spark: SparkSession, path: str) -> None:
    """Move a complete staged write, day by day or whole, into the table; nothing is written again.

    May be repeated after a stop at any point: the list of touched days is dropped before the first
    day is moved, and a day that is still staged was not moved yet.
    """
    folder = _staged(path)
    if is_versioned(spark, path):
        publish_staged(spark, path)
        return
    if exists(spark, f"{folder}/rows/_SUCCESS"):
        staged = [name for name in children(spark, f"{folder}/rows") if "=" in name]
        if exists(spark, f"{folder}/touched"):
            touched = spark.read.parquet(f"{folder}/touched").collect()  # calendar days
            for name in {row["name"] for row in touched} - set(staged):
                drop(spark, f"{path}/{name}")  # a day that lost all its rows
            drop(spark, f"{folder}/touched")
        for name in staged:
            move(spark, f"{folder}/rows/{name}", f"{path}/{name}")
        if any(name.endswith(".parquet") for name in children(spark, f"{folder}/rows")):
            move(spark, f"{folder}/rows", path)
    drop(spark, folder)


def write_table(df: DataFrame, path: str) -> None:
    """Full rebuild."""
    df.write.mode("overwrite").parquet(path)


def jdbc_options(
    url: str, table: str, day: str | None = None, partitions: int = 1, **credentials: str
) -> dict[str, str]:
    """Reader options for a table in a database; several partitions split it by event time."""
    where = f" WHERE event_date = DATE '{day}'" if day else ""
    options = {"url": url, "dbtable": f"(SELECT * FROM {table}{where}) AS t", **credentials}
    if partitions > 1:
        options |= {"partitionColumn": "event_timestamp", "numPartitions": str(partitions)}
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    day: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
    **credentials: str,
) -> DataFrame:
    """Read over JDBC, in parallel when the time `bounds` to split at are given."""
    options = jdbc_options(url, table, day, partitions if bounds else 1, **credentials)
    if bounds:
        options |= {"lowerBound": bounds[0], "upperBound": bounds[1]}
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 5000, **credentials: str) -> None:
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=str(batch), **credentials)
        .mode("append")
        .save()
    )
