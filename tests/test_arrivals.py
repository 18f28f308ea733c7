"""Lines that are not whole, times in several spellings, listings, and streams into the daily job's tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clickmill.operators import bronze
from clickmill.plans import daily_run
from clickmill.schemas import RAW
from clickmill.sources import raw_files
from clickmill.streaming import file_stream
from helpers import rows, write_csv
from test_bronze import HEADER, line
from test_daily_run import AS_OF, LAYERS, NOW, cell, deliver, snapshot, write_file

FOLDER = "event_date=2026-01-15"


def reasons(spark, root):
    return rows(daily_run.read_rows(spark, root), "event_id", "product_name", "reject_reason")


def test_faulty_lines_are_turned_away_and_short_ones_have_missing_values(spark, tmp_path):
    sound = line(event_id="a", product_name='"a, ""b"""')
    lines = [
        sound, line(event_id="more") + ",x,y", ",".join(line(event_id="short").split(",")[:8]),
        *line(event_id="broken", product_name='"one\ntwo"').split("\n"),
    ]
    write_csv(tmp_path / "landing" / FOLDER / "a.csv", HEADER, lines)
    root = str(tmp_path / "root")
    assert daily_run.load(spark, str(tmp_path / "landing"), root, NOW, "b") == (5, 3)
    got = {r[0]: r[2] for r in reasons(spark, root)}
    assert got["a"] == "" and got["short"] == ""
    assert got["more"] == "extra_cells" and got["broken"] == "open_quote"
    assert sum(r[2].endswith("open_quote") for r in reasons(spark, root)) == 2
    assert {r[0]: r[1] for r in reasons(spark, root)}["a"] == 'a, "b"'

    whole = str(tmp_path / "whole")
    assert daily_run.load(spark, str(tmp_path / "landing"), whole, NOW, "b", multi_line=True) == (4, 1)
    assert ("broken", "one\ntwo", "") in reasons(spark, whole)


def test_a_header_of_its_own_counts_the_cells(spark, tmp_path):
    path = tmp_path / "landing" / FOLDER / "a.csv"
    write_csv(path, "event_id,user_id,event_type,event_timestamp,event_date", [
        "a,u,click,2026-01-15T10:00:00,2026-01-15", "b,u,click,2026-01-15T10:00:00,2026-01-15,more"])
    root = str(tmp_path / "root")
    daily_run.load(spark, str(tmp_path / "landing"), root, NOW, "b")
    assert [(r[0], r[2]) for r in reasons(spark, root)] == [("a", ""), ("b", "extra_cells")]


TIMES = [
    ("2024-01-02T10:00:00", datetime(2024, 1, 2, 10)),
    ("2024-01-02 10:00:00.123456", datetime(2024, 1, 2, 10, 0, 0, 123456)),
    ("2024/3/4 05:06", datetime(2024, 3, 4, 5, 6)),
    ("7.8.2024 09:10:11", datetime(2024, 8, 7, 9, 10, 11)),
    ("13/02/2024 10:00:05", datetime(2024, 2, 13, 10, 0, 5)),
    ("02/13/2024", datetime(2024, 2, 13)),
    ("05/05/2024 1:02", datetime(2024, 5, 5, 1, 2)),
    ("01/02/2024 10:00", "null_event_timestamp,ambiguous_event_timestamp"),
    ("31.02.2024", "null_event_timestamp"),
    ("13/13/2024", "null_event_timestamp"),
    ("nope", "null_event_timestamp"),
    (None, "null_event_timestamp"),
]


def test_times_are_read_by_the_first_format_that_fits(spark):
    columns = [*RAW.fieldNames(), "source_file", "source_path"]
    held = [
        {**dict.fromkeys(columns), "event_id": str(i), "user_id": "u", "event_type": "click", "event_timestamp": text,
         "event_date": "3/14/2024"} for i, (text, _) in enumerate(TIMES)
    ]
    raw = spark.createDataFrame([tuple(r[c] for c in columns) for r in held], ", ".join(f"{c} string" for c in columns))
    for r in bronze.typed_rows(raw, NOW, "b").collect():
        want = TIMES[int(r.event_id)][1]
        assert (r.reject_reason if isinstance(want, str) else r.event_timestamp) == want
        assert str(r.event_date) == "2024-03-14"


def test_a_first_load_collects_no_names(spark, tmp_path, monkeypatch):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    for i in range(30):
        write_file(landing, "2026-01-15", f"f{i}", cell(f"e{i}", "2026-01-15"))
    asked = []
    read = raw_files.read_raw
    monkeypatch.setattr(daily_run, "read_raw", lambda spark, paths, **k: asked.append(paths) or read(spark, paths, **k))
    assert daily_run.load(spark, str(landing), root, NOW, "b") == (30, 0)
    write_file(landing, "2026-01-15", "g", cell("late", "2026-01-15"))
    assert daily_run.load(spark, str(landing), root, NOW, "b") == (1, 0)
    assert asked[0] == [f"{landing}/event_date=*"] and len(asked[1]) == 1 and asked[1][0].endswith("/g.csv")
    assert daily_run.read_ledger(spark, root).count() == 31


def test_files_that_arrive_after_the_listing_wait_for_the_next_load(spark, tmp_path, monkeypatch):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    write_file(landing, "2026-01-15", "a", cell("a", "2026-01-15"))
    listed = daily_run.write_table

    def arrives(df, path):
        listed(df, path)
        if path.endswith("listed_files"):
            write_file(landing, "2026-01-15", "b", cell("b", "2026-01-15"))

    with monkeypatch.context() as patch:
        patch.setattr(daily_run, "write_table", arrives)
        assert daily_run.load(spark, str(landing), root, NOW, "1") == (1, 0)
    assert daily_run.load(spark, str(landing), root, NOW, "2") == (1, 0)
    assert rows(daily_run.read_bronze(spark, root), "event_id") == [("a",), ("b",)]


def test_a_stream_fills_the_tables_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    landing, root, whole = tmp_path / "landing", str(tmp_path / "root"), str(tmp_path / "whole")
    deliver(landing, "2026-01-15", "a", "a", "b")
    file_stream.publish_available(spark, str(landing), root, f"{tmp_path}/checkpoint", NOW, AS_OF)
    write_file(landing, "2026-01-17", "c", cell("c", "2026-01-17"), cell("a", "2026-01-14"))
    file_stream.publish_available(spark, str(landing), root, f"{tmp_path}/checkpoint", NOW, AS_OF)
    daily_run.run(spark, str(landing), whole, NOW, AS_OF, "all")
    marts = LAYERS[2:]
    got, want = snapshot(spark, root), snapshot(spark, whole)
    assert {n: got[n] for n in marts} == {n: want[n] for n in marts}

    raw = raw_files.read_raw(spark, str(landing / "event_date=2026-01-17"))
    assert daily_run.load_batch(spark, raw, root, "checkpoint", 1, NOW) == (0, 0)
    daily_run.carry(spark, root, NOW, AS_OF)
    assert snapshot(spark, root) == got
    assert daily_run.load_batch(spark, raw, root, "checkpoint", 2, NOW) == (2, 0)  # a batch of its own


def test_a_stopped_batch_is_made_good_when_the_stream_repeats_it(spark, tmp_path, monkeypatch):
    landing, root, whole = tmp_path / "landing", str(tmp_path / "root"), str(tmp_path / "whole")
    deliver(landing, "2026-01-15", "a", "b")
    with monkeypatch.context() as patch:
        patch.setattr(daily_run, "replace_daily_kpis", lambda *a: 1 / 0)
        with pytest.raises(Exception, match="division"):
            file_stream.publish_available(spark, str(landing), root, f"{tmp_path}/checkpoint", NOW, AS_OF)
    file_stream.publish_available(spark, str(landing), root, f"{tmp_path}/checkpoint", NOW, AS_OF)
    daily_run.run(spark, str(landing), whole, NOW, AS_OF, "all")
    got, want = snapshot(spark, root), snapshot(spark, whole)
    assert {n: got[n] for n in LAYERS[2:]} == {n: want[n] for n in LAYERS[2:]}
    assert daily_run.read_rows(spark, root).where(F.col("load_id") > 1).isEmpty()
