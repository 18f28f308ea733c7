"""Where the rows of each event id lie: a table bucketed by id, which lookups by id do not shuffle.

Every load appends the places of its accepted rows before it counts. Places of rows that were superseded, or
of a load that stopped and was written again, stay: a lookup may name a day in vain, but never misses one.
"""

from hashlib import md5

from pyspark.sql import DataFrame, SparkSession

from clickmill.sources.folders import children, drop, exists, qualified

PLACES = ["event_id", "event_day", "event_date"]
LEAST_BUCKETS = 16


def _generation(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """(generation, buckets) of the newest complete table under `path`."""
    if not exists(spark, path):
        return None
    names = [n for n in children(spark, path) if exists(spark, f"{path}/{n}/_SUCCESS")]
    return max((tuple(map(int, n.split("_of_"))) for n in names), default=None)


def _open(spark: SparkSession, path: str, generation: int, buckets: int) -> str:
    """Name of the table in this session's catalog, which alone knows the buckets of its files."""
    place = qualified(spark, f"{path}/{generation}_of_{buckets}")
    name = f"event_index_{md5(place.encode()).hexdigest()}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (event_id STRING, event_day STRING, event_date DATE) USING parquet"
        f" CLUSTERED BY (event_id) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return name


def append_places(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Add the places of `rows`; each bucket gets one file."""
    wanted = max(LEAST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    generation, buckets = _generation(spark, path) or (1, wanted)
    name = _open(spark, path, generation, buckets)
    rows.select(PLACES).repartition(buckets, "event_id").write.mode("append").insertInto(name)


def read_places(spark: SparkSession, path: str) -> DataFrame | None:
    found = _generation(spark, path)
    if found is None:
        return None
    name = _open(spark, path, *found)
    spark.catalog.refreshTable(name)  # another session may have added files
    return spark.table(name)


def compact_places(spark: SparkSession, path: str, buckets: int | None = None) -> None:
    """Write each place once, in one file per bucket (as many buckets as asked for), as a new generation;
    the old one goes once the new one is complete."""
    found = _generation(spark, path)
    if found is None:
        return
    old = f"{found[0]}_of_{found[1]}"
    name = _open(spark, path, found[0] + 1, buckets or found[1])
    once = read_places(spark, path).distinct().repartition(buckets or found[1], "event_id")
    once.write.mode("overwrite").insertInto(name)
    drop(spark, f"{path}/{old}")


def places_of(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """`event_id`, `event_day`, `event_date` of the rows of these ids, read from their buckets alone."""
    return read_places(spark, path).join(ids, "event_id", "left_semi")
