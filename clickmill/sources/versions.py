"""Parquet tables in versions: data folders that never change, and a manifest per version, written last.

A version's manifest lists its partitions and the data folder that holds each of them. Publishing writes the
changed partitions into a folder of their own and then the manifest, which counts once its marker of a
complete write is there; nothing is renamed or written over. A reader takes the newest complete manifest and
sees that version as a whole, whatever is published meanwhile. The last `KEPT` versions stay for readers that
are still at work. One job at a time may write a table; a write that stopped is finished or written again.

Tables are kept in versions in every folder where `keep_versions` was called, see `tables`.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickmill.sources.folders import children, drop, exists, require_marker, write_partitions

MANIFEST = "partition string, version int"
KEPT = 2


def keep_versions(spark: SparkSession, root: str) -> None:
    """From now on new tables right under `root` are kept in versions."""
    spark.range(0).write.mode("overwrite").parquet(f"{root}/_versioned")


def is_versioned(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path.rstrip('/').rpartition('/')[0]}/_versioned")


def _complete(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete writes in a folder, oldest first."""
    if not exists(spark, folder):
        return []
    numbers = [n.removeprefix("v=") for n in children(spark, folder)]
    return sorted(int(n) for n in numbers if n.isdigit() and exists(spark, f"{folder}/{_of(folder, n)}/_SUCCESS"))


def _of(folder: str, number: int | str) -> str:
    return f"v={number}" if folder.endswith("/data") else str(number)


def current(spark: SparkSession, path: str) -> int | None:
    """The newest version that counts."""
    return max(_complete(spark, f"{path}/_versions"), default=None)


def manifest(spark: SparkSession, path: str, version: int) -> dict[str, int]:
    """Partition folder ('' for a table without partitions) -> the version that wrote it."""
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/_versions/{version}").collect()  # calendar days
    return {r["partition"]: r["version"] for r in rows}


def read_version(
    spark: SparkSession, path: str, schema: T.StructType | None = None, version: int | None = None
) -> DataFrame | None:
    """A version of the table, the newest unless one is named; None if there is none, or it has no rows and
    no `schema` says what they would look like."""
    version = version or current(spark, path)
    if version is None:
        return None
    data = f"{path}/data"
    folders = [f"{data}/v={v}/{p}".rstrip("/") for p, v in sorted(manifest(spark, path, version).items())]
    if not folders:
        return None if schema is None else spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", data)
    return (reader.schema(schema) if schema is not None else reader).parquet(*folders).drop("v")


def stage_version(
    df: DataFrame, path: str, touched: Sequence[str] = (), sort: Sequence[str] = (), key: str | None = None
) -> None:
    """Write the data of the next version: the partitions of `df`, with `touched` those that it replaces or
    empties; without `key` the whole table."""
    spark = df.sparkSession
    drop_version(spark, path)
    number = (current(spark, path) or 0) + 1
    if touched:
        names = spark.createDataFrame([(f"{key}={d}",) for d in touched], "name string")
        names.write.mode("overwrite").parquet(f"{path}/_touched/{number}")
    if key:
        write_partitions(df, f"{path}/data/v={number}", (key,), sort, "all")
    else:
        df.write.mode("overwrite").parquet(f"{path}/data/v={number}")
    require_marker(spark, f"{path}/data/v={number}")


def drop_version(spark: SparkSession, path: str) -> None:
    """Give up data that no manifest names yet."""
    number = (current(spark, path) or 0) + 1
    for folder in (f"data/v={number}", f"_versions/{number}", f"_touched/{number}"):
        drop(spark, f"{path}/{folder}")


def publish_staged(spark: SparkSession, path: str) -> None:
    """Make complete staged data the newest version; may be repeated after a stop at any point."""
    now = current(spark, path)
    number = (now or 0) + 1
    if number not in _complete(spark, f"{path}/data"):
        return
    staged = [name for name in children(spark, f"{path}/data/v={number}") if "=" in name]
    whole = not staged and not exists(spark, f"{path}/_touched/{number}")
    held = manifest(spark, path, now) if now and not whole else {}
    if exists(spark, f"{path}/_touched/{number}"):
        for row in spark.read.parquet(f"{path}/_touched/{number}").collect():  # calendar days
            held.pop(row["name"], None)
    held |= {"": number} if whole else dict.fromkeys(staged, number)
    rows = spark.createDataFrame(sorted(held.items()), MANIFEST)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/_versions/{number}")
    require_marker(spark, f"{path}/_versions/{number}")
    clean_up(spark, path)


def clean_up(spark: SparkSession, path: str, kept: int = KEPT) -> None:
    """Remove all but the last versions, then the data that none of these names."""
    numbers = _complete(spark, f"{path}/_versions")
    stay, gone = numbers[-kept:], numbers[:-kept]
    named = {v for n in stay for v in manifest(spark, path, n).values()}
    for number in gone:
        drop(spark, f"{path}/_versions/{number}")
    for number in _complete(spark, f"{path}/data"):
        if number <= stay[-1] and number not in named:
            drop(spark, f"{path}/data/v={number}")
