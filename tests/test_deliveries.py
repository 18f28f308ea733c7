"""Input of the queries that load files in two deliveries, and cells that are read once."""

from pyspark.sql import functions as F

from clickmill.operators import bronze
from clickmill.plans import queries
from clickmill.schemas import RAW
from helpers import plan, rows

SMALL = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
}


def texts(spark, days):
    """Raw rows with a delivery day each, null for none."""
    df = spark.createDataFrame([(str(i), d) for i, d in enumerate(days)], "event_id string, day string")
    cells = [F.lit("x").alias(c) for c in RAW.fieldNames() if c != "event_id"]
    return df.select("event_id", *cells, F.col("day").cast("date").alias("file_date"))


def test_deliveries_part_the_rows_and_read_what_was_written_once(spark, folder):
    text = texts(spark, ["2024-01-01", "2024-01-03", None, "2024-01-02", "2024-01-03"])
    text.write.parquet(f"{folder}/input")
    text = spark.read.parquet(f"{folder}/input")
    first, second = queries._deliveries(text, F.col("file_date") <= F.lit("2024-01-02").cast("date"), folder)
    assert sorted(r[0] for r in rows(first, "event_id")) == ["0", "3"]
    assert sorted(r[0] for r in rows(second, "event_id")) == ["1", "4"]  # without a day: in neither, as by a filter
    assert first.columns == second.columns == text.columns
    read = spark.read.parquet(f"{folder}/sent").inputFiles()
    assert set(first.inputFiles()) == set(second.inputFiles()) == set(read)  # the input is not derived again


def test_as_many_tasks_write_the_stream_s_files_as_the_rows_ask_for(spark, folder):
    text = texts(spark, ["2024-01-01"] * 4000).repartition(8)
    before = {key: spark.conf.get(key) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    try:
        queries._land(text, f"{folder}/landing")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    landed = spark.read.option("header", "true").csv(f"{folder}/landing")
    assert len(landed.inputFiles()) > 2
    assert sorted(landed.columns) == sorted(RAW.fieldNames()) and landed.select("event_id").distinct().count() == 4000


def test_a_time_is_read_as_iso_once(spark, folder):
    spark.range(1).select(F.col("id").cast("string").alias("t")).write.parquet(f"{folder}/cells")
    cells = spark.read.parquet(f"{folder}/cells")
    for kind in ("timestamp_ntz", "date"):
        assert plan(cells.select(bronze.read_time("t", kind).alias("at"))).count("try_cast") == 1


def test_blanks_and_numbers_of_any_kind(spark):
    cells = ["e1", "  ", " ", "é", " a", "​", None]
    frame = spark.createDataFrame([(c,) for c in cells], "event_id string")
    filled = [F.lit("u").alias(c) for c in ("user_id", "event_type")]
    when = [F.lit("2024-01-01").alias(c) for c in ("event_timestamp", "event_date")]
    reasons = frame.select("event_id", *filled, *when).select(F.array_join(bronze.problems(), ",").alias("r"))
    assert [r.r for r in reasons.collect()] == ["", "blank_event_id", "blank_event_id", "", "", "", "null_event_id"]
    numbers = ["1.5", "99999999999.00", "abc", None, "1e40", "NaN"]
    frame = spark.createDataFrame([(n, "1") for n in numbers], "product_price string, quantity string")
    frame = frame.select("product_price", "quantity", *[F.lit("0").alias(c) for c in ("revenue", "cashback_amount")])
    found = frame.select(F.array_join(bronze.overflows(), ",").alias("r")).collect()
    assert [r.r for r in found] == ["", "overflow_product_price", "", "", "overflow_product_price", ""]
