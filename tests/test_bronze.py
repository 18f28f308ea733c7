from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest

from clickmill.operators import bronze
from clickmill.plans import daily_run
from clickmill.schemas import BRONZE, RAW
from clickmill.sources.raw_files import list_files, not_loaded, read_raw, read_raw_any
from clickmill.sources.tables import jdbc_options
from helpers import rows, write_csv

NOW = "2026-02-01 00:00:00"
HEADER = ",".join(RAW.fieldNames())


def line(**cells):
    base = {"event_id": "e1", "user_id": "u1", "event_type": "page_view",
            "event_timestamp": "2026-01-15T10:00:00", "event_date": "2026-01-15"}
    full = {**base, **cells}
    return ",".join(full.get(c, "") for c in RAW.fieldNames())


def load(spark, path):
    return bronze.typed_rows(read_raw_any(spark, [str(path)]), NOW, "b1")


def test_reads_and_coerces_the_five_event_fixture(spark, tmp_path):
    lines = [
        line(event_id="e1", product_price="10.99", quantity="0", revenue="0"),
        line(event_id="e2", user_id="u2", event_type="click", product_price="20.50"),
        line(event_id="e3", user_id="u3", event_type="purchase", event_timestamp="2026-01-15T12:00:00",
             product_price="99.99", quantity="2", revenue="199.98"),
        line(event_id="e4", event_type="add_to_cart", product_price="15.00", quantity="1"),
        line(event_id="e5", user_id="u2", product_price="5.99"),
    ]
    write_csv(tmp_path / "events_2026-01-15.csv", HEADER, lines)
    got = bronze.accepted(load(spark, tmp_path / "events_2026-01-15.csv"))
    assert got.schema.simpleString() == BRONZE.simpleString()
    e3 = got.where("event_id = 'e3'").first()
    assert (e3.product_price, e3.quantity, e3.revenue) == (Decimal("99.99"), 2, Decimal("199.98"))
    assert e3.event_timestamp == datetime(2026, 1, 15, 12)
    assert (e3.source_file, e3.batch_id, e3.ingested_at) == (
        "events_2026-01-15.csv", "b1", datetime(2026, 2, 1))
    assert got.count() == 5


def test_null_tokens_bad_cells_and_blanks(spark, tmp_path):
    lines = [
        line(event_id="ok", product_price="abc", quantity="", revenue="1e2", cashback_amount="inf"),
        line(event_id="q", quantity="2.5", referrer="NA"),
        line(event_id="NA"),
        line(event_id="n2", user_id="NULL"),
        line(event_id="n3", event_type='""'),
        line(event_id="n4", event_timestamp="not-a-date"),
        line(event_id="n5", user_id="nan", event_date="2026-13-01"),
        line(event_id="n6", user_id=" \t "),
    ]
    write_csv(tmp_path / "x.csv", HEADER, lines)
    all_rows = load(spark, tmp_path / "x.csv")
    ok = {r.event_id: r for r in bronze.accepted(all_rows).collect()}
    assert set(ok) == {"ok", "q"}
    assert (ok["ok"].product_price, ok["ok"].quantity) == (Decimal("0.00"), 0)
    assert (ok["ok"].revenue, ok["ok"].cashback_amount) == (Decimal("100.00"), Decimal("0.00"))
    assert (ok["q"].quantity, ok["q"].referrer) == (3, None)
    assert rows(bronze.rejected(all_rows), "reject_reason") == [
        ("blank_user_id",), ("null_event_id",), ("null_event_timestamp",), ("null_event_type",),
        ("null_user_id",), ("null_user_id,null_event_date",),
    ]
    assert sum(r[0] for r in rows(bronze.reject_counts(all_rows), "rejected_rows")) == 6


def test_quoted_cells(spark, tmp_path):
    write_csv(tmp_path / "x.csv", HEADER, [line(product_name='"a ""big"", red one"')])
    assert rows(load(spark, tmp_path / "x.csv"), "product_name") == [('a "big", red one',)]


def test_the_date_in_the_file_counts(spark, tmp_path):
    file = tmp_path / "event_date=2024-01-01" / "x.csv"
    write_csv(file, HEADER, [line(event_date="2024-03-01", event_timestamp="2024-03-01T08:00:00")])
    got = bronze.typed_rows(read_raw(spark, str(tmp_path)), NOW, "b").first()
    assert (got.event_date, got.event_id, got.source_path) == (
        date(2024, 3, 1), "e1", "event_date=2024-01-01/x.csv")


def test_files_with_fewer_or_reordered_columns(spark, tmp_path):
    names = [c for c in RAW.fieldNames() if c not in ("referrer", "city")]
    short = {"event_id": "s", "user_id": "u", "event_type": "click", "country": "X",
             "event_timestamp": "2026-01-15T10:00:00", "event_date": "2026-01-15"}
    write_csv(tmp_path / "short.csv", ",".join(reversed(names)),
              [",".join(short.get(c, "") for c in reversed(names))])
    write_csv(tmp_path / "full.csv", HEADER, [line(event_id="f", city="Y")])
    files = [str(tmp_path / f) for f in ("short.csv", "full.csv")]
    got = rows(read_raw_any(spark, files), "event_id", "country", "event_type")
    assert got == [("f", None, "page_view"), ("s", "X", "click")]
    assert read_raw_any(spark, files).where("event_id = 's' AND city IS NULL").count() == 1
    with pytest.raises(Exception, match="CSV header"):
        read_raw(spark, files).collect()


def test_listing_one_day_or_all(spark, tmp_path):
    for d in ("2026-01-15", "2026-01-16"):
        write_csv(tmp_path / f"event_date={d}" / "events.csv", HEADER, [line(event_date=d)])
    (tmp_path / "event_date=2026-01-16" / "notes.txt").write_text("no data")
    (tmp_path / "event_date=stray").write_text("a file, not a folder")
    both = list_files(spark, str(tmp_path))
    assert rows(both, "source_path") == [
        ("event_date=2026-01-15/events.csv",), ("event_date=2026-01-16/events.csv",)]
    assert list_files(spark, str(tmp_path), "2026-01-16").count() == 1
    loaded = list_files(spark, str(tmp_path), "2026-01-15")
    assert rows(not_loaded(both, loaded), "source_path") == [("event_date=2026-01-16/events.csv",)]


def bronze_table(spark, folder):
    return daily_run.read_rows(spark, folder)


def test_ingest_is_incremental_and_repeatable(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    write_csv(landing / "event_date=2026-01-15" / "a.csv", HEADER, [line(event_id="a"), line(user_id="")])
    assert daily_run.ingest(spark, str(landing), root, NOW, "b1") == 2
    assert daily_run.ingest(spark, str(landing), root, NOW, "b2") == 0
    write_csv(landing / "event_date=2026-01-16" / "a.csv", HEADER, [line(event_id="b", event_date="2026-01-16")])
    assert daily_run.ingest(spark, str(landing), root, NOW, "b2") == 1
    assert rows(daily_run.read_bronze(spark, root), "event_id", "batch_id") == [("a", "b1"), ("b", "b2")]
    assert rows(daily_run.read_bronze(spark, root, "2026-01-16"), "event_id") == [("b",)]
    assert daily_run.read_rejects(spark, root).count() == 1
    # a forced run of the same batch replaces it
    assert daily_run.ingest(spark, str(landing), root, NOW, "b2", day="2026-01-16", force=True) == 1
    assert bronze_table(spark, root).count() == 3


def test_ingest_looks_at_headers_when_they_differ(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    write_csv(landing / "event_date=2026-01-15" / "full.csv", HEADER, [line(event_id="f")])
    short = "event_id,user_id,event_type,event_timestamp,event_date"
    write_csv(landing / "event_date=2026-01-15" / "short.csv", short, ["s,u,click,2026-01-15 01:02:03,2026-01-15"])
    assert daily_run.ingest(spark, str(landing), root, NOW, "b1") == 2
    assert rows(daily_run.read_bronze(spark, root), "event_id", "product_price") == [
        ("f", Decimal("0.00")), ("s", Decimal("0.00"))]


def test_ingest_of_nothing(spark, tmp_path):
    (tmp_path / "landing" / "event_date=2026-01-15").mkdir(parents=True)
    assert daily_run.ingest(spark, str(tmp_path / "landing"), str(tmp_path), NOW, "b1") == 0
    assert not Path(tmp_path / "bronze").exists()


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "bronze.raw_events", "2026-01-15", partitions=4, user="u")
    assert options["dbtable"] == "(SELECT * FROM bronze.raw_events WHERE event_date = DATE '2026-01-15') AS t"
    assert (options["numPartitions"], options["user"]) == ("4", "u")
    assert "partitionColumn" not in jdbc_options("jdbc:x", "t")


def test_numbers_too_large_for_their_column_are_rejected(spark, tmp_path):
    cells = [
        dict(event_id="p", product_price="12345678901.50"), dict(event_id="q", quantity="3000000000"),
        dict(event_id="r", revenue="-99999999999", cashback_amount="1e20"), dict(event_id="s", product_price="abc", quantity="9x"),
        dict(event_id="t", revenue="9999999999.99"),
    ]
    write_csv(tmp_path / "a.csv", HEADER, [line(**c) for c in cells])
    typed = bronze.typed_rows(read_raw(spark, str(tmp_path)), NOW, "b")
    assert rows(typed, "event_id", "reject_reason") == [
        ("p", "overflow_product_price"), ("q", "overflow_quantity"),
        ("r", "overflow_revenue,overflow_cashback_amount"), ("s", ""), ("t", "")]
