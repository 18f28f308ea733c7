from datetime import datetime

from clickmill.operators import bronze, silver
from clickmill.schemas import BRONZE_ROWS, RAW
from clickmill.sources.raw_files import read_raw
from clickmill.streaming import file_stream as S
from helpers import rows, typed, write_csv
from test_bronze import HEADER, line


def test_each_file_is_read_once(spark, tmp_path):
    landing, out, mark = (str(tmp_path / n) for n in ("landing", "bronze", "checkpoint"))

    def run(batch):
        S.write_available(S.bronze_stream(S.raw_stream(spark, landing), batch), out, mark)
        table = spark.read.schema(BRONZE_ROWS).parquet(out)
        return rows(bronze.accepted(table), "event_id", "batch_id")

    day = tmp_path / "landing" / "event_date=2026-01-15"
    write_csv(day / "a.csv", HEADER, [line(event_id="a"), line(event_id="bad", user_id="")])
    assert run("b1") == [("a", "b1")]
    assert run("b2") == [("a", "b1")]
    write_csv(day / "b.csv", HEADER, [line(event_id="b", product_price="x")])
    assert run("b3") == [("a", "b1"), ("b", "b3")]
    batch = bronze.typed_rows(read_raw(spark, landing), "2026-01-01", "b")
    assert rows(bronze.accepted(batch), *RAW.fieldNames()[:5], "product_price") == rows(
        bronze.accepted(spark.read.schema(BRONZE_ROWS).parquet(out)), *RAW.fieldNames()[:5], "product_price"
    )


def dedup(spark, tmp_path, batches):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for batch in batches:
        batch.write.mode("append").parquet(source)
        stream = spark.readStream.schema(batch.schema).parquet(source)
        S.write_available(S.dedup_stream(stream), out, mark)
    return spark.read.schema(batches[0].schema).parquet(out)


def test_copies_are_dropped_within_and_across_batches(spark, tmp_path):
    first = typed(spark, [{"event_id": i} for i in ("a", "a", "b", None, None)]).repartition(3)
    second = typed(spark, [{"event_id": i} for i in ("b", "c", None)])
    got = dedup(spark, tmp_path, [first, second])
    both = first.unionByName(second)
    assert rows(got.fillna("-"), "event_id") == [("-",), ("a",), ("b",), ("c",)]
    assert rows(got.fillna("-"), "event_id") == rows(silver.dedup_events(both).fillna("-"), "event_id")


def test_future_and_old_events_do_not_push_others_out(spark, tmp_path):
    future = typed(spark, [{"event_id": "f", "event_timestamp": datetime(2030, 1, 1)}])
    old = typed(spark, [{"event_id": "o", "event_timestamp": datetime(2020, 1, 1)}])
    got = dedup(spark, tmp_path, [future, old, typed(spark, [{"event_id": "n"}])])
    assert rows(got, "event_id") == [("f",), ("n",), ("o",)]


def test_a_hot_id(spark, tmp_path):
    events = typed(spark, [{"event_id": "hot"}] * 300 + [{"event_id": f"e{i}"} for i in range(50)])
    assert dedup(spark, tmp_path, [events.repartition(6)]).count() == 51
