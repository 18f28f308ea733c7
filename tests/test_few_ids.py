"""Whole rows meet the few ids that they share with a load, however many ids the load has."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from clickmill.plans import daily_run, incremental
from clickmill.sources import tables
from clickmill.sources.folders import exists
from helpers import facts, plan, rows
from test_daily_run import AS_OF, NOW, cell, deliver, write_file

DAYS = [date(2026, 1, 15), date(2026, 1, 16)]


@pytest.fixture
def narrow(spark):
    """Tables of some kilobytes are too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "4k")
    yield
    spark.conf.set(key, before)


def staged(monkeypatch, module, name):
    """The plans of the frames that are written."""
    seen, write = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda df, path, *a, **k: seen.append((path, plan(df))) or write(df, path, *a, **k))
    return seen


def test_kept_rows_are_not_shuffled_to_meet_a_load_s_new_ids(spark, folder, monkeypatch, narrow):
    path = f"{folder}/fact"
    old = [{"event_id": f"old{i}", "event_date": DAYS[i % 2]} for i in range(50)]
    incremental.replace_events(facts(spark, old), path, None, [])
    spark.range(20000).selectExpr("concat('new', id) AS event_id").write.parquet(f"{folder}/new")
    spark.createDataFrame([("old3",), ("old4",)], "event_id string").write.mode("append").parquet(f"{folder}/new")
    ids = spark.read.parquet(f"{folder}/new")
    new = facts(spark, [{"event_id": "old3", "event_date": DAYS[0]}, {"event_id": "new1", "event_date": DAYS[1]}])
    seen = staged(monkeypatch, incremental, "stage")
    assert incremental.replace_events(new, path, ids, DAYS)["rows"] == 2
    (written,) = (text for at, text in seen if at == path)
    assert "BroadcastHashJoin" in written and "SortMergeJoin" not in written and "hashpartitioning" not in written
    left = {f"old{i}" for i in range(50) if i != 4} | {"new1"}
    assert sorted(left) == [r[0] for r in rows(tables.read_table(spark, path), "event_id")]
    moved = tables.read_table(spark, path).where("event_id = 'old3'").select("event_date").first()[0]
    assert moved == DAYS[0] and not exists(spark, f"{path}__ids")


def test_rows_of_a_load_are_cleaned_without_a_join(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    deliver(landing, "2026-01-15", "a", "b")
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b1")
    deliver(landing, "2026-01-16", "b", "c", "d")
    write_file(landing, "2026-01-17", "late", cell("a", "2026-01-14", user_id="other"))
    daily_run.load(spark, str(landing), root, NOW, "b2")
    change = daily_run.pending(spark, root, NOW)
    assert rows(change.former, "event_id") == [("a",), ("b",)] and (change.done, change.last) == (1, 2)
    text = plan(daily_run._rows_of(daily_run._loaded_rows(spark, root), change))
    assert text.count("LeftSemi") == 1 and text.split("LeftSemi")[0].count("Union") == 1
    cleaned = daily_run.clean_rows(spark, root, NOW, change).select("event_id", F.col("event_date").cast("string"))
    assert rows(cleaned) == [("a", "2026-01-14"), ("b", "2026-01-15"), ("c", "2026-01-16"), ("d", "2026-01-16")]


def test_a_run_that_stops_between_silver_and_fact_finds_the_ids_again(spark, tmp_path, monkeypatch):
    """The second attempt meets a silver table without the ids that the fact still has."""
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    write_file(landing, "2026-01-15", "a", cell("x", "2026-01-15"), cell("y", "2026-01-15"))
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b1")
    write_file(landing, "2026-01-15", "a", cell("y", "2026-01-14"))  # without x
    with monkeypatch.context() as patch:
        patch.setattr(daily_run, "build_marts", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            daily_run.run(spark, str(landing), root, NOW, AS_OF, "b2", force=True)
    daily_run.carry(spark, root, NOW, AS_OF)
    fact = tables.read_table(spark, f"{root}/fact_events").select("event_id", F.col("event_date").cast("string"))
    assert rows(fact) == [("y", "2026-01-14")]
