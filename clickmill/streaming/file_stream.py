"""Incremental file ingestion and de-duplication with Structured Streaming."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickmill.functions.columns import checked_day
from clickmill.operators.bronze import typed_rows
from clickmill.plans import daily_run
from clickmill.schemas import LOOKBACK_DAYS, RAW
from clickmill.sources.raw_files import CSV_OPTIONS, LINE, line_fault, lineage_columns


def raw_stream(
    spark: SparkSession, landing: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Raw text rows of files as they arrive; the source's checkpoint knows the files it has read."""
    reader = (
        spark.readStream.schema(T.StructType([*RAW.fields, T.StructField(LINE, T.StringType())]))
        .options(**CSV_OPTIONS, enforceSchema="false", recursiveFileLookup="true", columnNameOfCorruptRecord=LINE)
        .option("pathGlobFilter", "*.csv")
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    fault = line_fault(len(RAW.fields)).alias("line_fault")
    return reader.csv(landing).select(*RAW.fieldNames(), *lineage_columns(), fault)


def bronze_stream(raw: DataFrame, batch_id: str) -> DataFrame:
    """The batch transforms of bronze on a stream: rows in the bronze schema with `reject_reason`."""
    return typed_rows(raw, F.current_timestamp(), batch_id)


def dedup_stream(rows: DataFrame, tolerance: str = f"{LOOKBACK_DAYS} days") -> DataFrame:
    """Drop copies of an event id that arrive within `tolerance` of the first one.

    The watermark follows the arrival time, not the event time: a future-dated event would move an
    event-time watermark past all others, and rows behind it would be lost. Here no row is ever
    late. The first pass removes the copies within each reading task, so that an id with very many
    copies does not reach one task as a whole.
    """
    arriving = rows.withColumns(
        {"arrived_at": F.current_timestamp(), "reader": F.spark_partition_id()}
    ).withWatermark("arrived_at", tolerance)
    return (
        arriving.dropDuplicatesWithinWatermark(["event_id", "reader"])
        .dropDuplicatesWithinWatermark(["event_id"])
        .drop("arrived_at", "reader")
    )


def publish_available(
    spark: SparkSession, landing: str, root: str, checkpoint: str, now: str, as_of: str, files_per_trigger: int | None = None
) -> StreamingQuery:
    """Bring everything that has arrived into the tables of the daily job, micro-batch by micro-batch, and stop.

    Each batch is a load of its own, and the ids in it are carried through all layers. Copies of an id are
    settled there, however late they come, where de-duplication within a watermark would let them through.
    A batch that is repeated after a stop is not loaded twice.
    """
    stream = checkpoint.rstrip("/").rpartition("/")[2]

    def batch(raw: DataFrame, number: int) -> None:
        daily_run.load_batch(spark, raw, root, stream, number, now)
        daily_run.carry(spark, root, now, as_of)

    query = (
        raw_stream(spark, landing, files_per_trigger)
        .writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything that has arrived, append it by `event_day`, and stop.

    Dates before 2020 or after the arrival share one partition: a wrong date opens none of its own.
    """
    query = (
        stream.withColumn("event_day", checked_day("event_date", F.current_timestamp()))
        .writeStream.format("parquet")
        .partitionBy("event_day")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query
