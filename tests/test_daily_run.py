import pytest
from pyspark.sql import functions as F

from clickmill.operators.quality import QualityError
from clickmill.plans import daily_run
from helpers import plan, rows, write_csv
from test_bronze import HEADER, line

NOW, AS_OF = "2026-02-01 00:00:00", "2026-02-01"
NOTHING = {"bronze": 0, "rejected": 0, "silver": 0, "invalid": 0}
LAYERS = ["bronze", "silver", "fact_events", "daily_kpis", "dim_users", "funnel_analysis", "retention"]


def deliver(landing, day, *ids, **cells):
    write_csv(
        landing / f"event_date={day}" / f"events_{day}.csv",
        HEADER,
        [line(event_id=i, event_date=day, event_timestamp=f"{day}T10:00:00", **cells) for i in ids],
    )


def snapshot(spark, root):
    tables = {n: spark.read.parquet(f"{root}/{n}") for n in LAYERS}
    return {n: rows(t.select([F.col(c).cast("string") for c in sorted(t.columns)]).fillna("-")) for n, t in tables.items()}


def test_days_run_one_by_one_and_again(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    deliver(landing, "2026-01-15", "a", "a", "b")
    deliver(landing, "2026-01-16", "c", "swipe1", event_type="swipe")
    deliver(landing, "2026-01-17", "d", event_type="purchase", revenue="10.00")
    for day in ("2026-01-15", "2026-01-16", "2026-01-17"):
        counts = daily_run.run(spark, str(landing), root, NOW, AS_OF, f"batch_{day}", day)
        assert counts["silver"] == {"2026-01-15": 2, "2026-01-16": 2, "2026-01-17": 1}[day]
    facts = spark.read.parquet(f"{root}/fact_events")
    assert rows(facts, "event_id") == [("a",), ("b",), ("d",)]
    before = snapshot(spark, root)
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "batch_again", "2026-01-17")
    assert snapshot(spark, root) == before

    checks = daily_run.check(spark, root, "2026-01-17")
    assert checks.where("NOT passed").count() == 0 and checks.count() == 28
    with pytest.raises(QualityError):
        daily_run.check(spark, str(_empty(spark, tmp_path, root)), "2026-01-17")

    whole = str(tmp_path / "whole")
    daily_run.run(spark, str(landing), whole, NOW, AS_OF, "all")
    same = ["fact_events", "daily_kpis", "dim_users", "funnel_analysis", "retention"]
    assert {n: snapshot(spark, whole)[n] for n in same} == {n: before[n] for n in same}


def _empty(spark, tmp_path, root):
    folder = tmp_path / "empty"
    daily_run.read_silver(spark, root).limit(0).write.parquet(str(folder / "silver"))
    return folder


def test_no_files_no_tables(spark, tmp_path):
    counts = daily_run.run(spark, str(tmp_path / "landing"), str(tmp_path / "root"), NOW, AS_OF, "b", "2026-01-15")
    assert counts == NOTHING
    with pytest.raises(QualityError, match="row_count"):
        daily_run.check(spark, str(tmp_path / "root"), "2026-01-15")


def test_a_day_without_files_leaves_the_others(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    deliver(landing, "2026-01-15", "a")
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b1", "2026-01-15")
    before = snapshot(spark, root)
    assert daily_run.run(spark, str(landing), root, NOW, AS_OF, "b2", "2026-01-16") == NOTHING
    assert snapshot(spark, root) == before
    checks = daily_run.check(spark, root, "2026-01-16")  # a warning, as other days have rows
    assert checks.where("NOT passed").count() == 0


def table(spark, root, name="fact_events", *columns):
    return rows(spark.read.parquet(f"{root}/{name}"), *(columns or ("event_id",)))


def write_file(landing, folder, name, *cells):
    write_csv(landing / f"event_date={folder}" / f"{name}.csv", HEADER, [line(**c) for c in cells])


def cell(event_id, day, at=None, **cells):
    return {"event_id": event_id, "event_date": day, "event_timestamp": f"{at or day}T10:00:00", **cells}


def test_a_batch_id_used_again_keeps_the_earlier_files(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    write_file(landing, "2026-01-16", "a", cell("a1", "2026-01-16"), cell("a2", "2026-01-16"))
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "same", "2026-01-16")
    write_file(landing, "2026-01-16", "b", cell("b1", "2026-01-16"), cell("b2", "2026-01-16", user_id=""))
    counts = daily_run.run(spark, str(landing), root, NOW, AS_OF, "same", "2026-01-16")
    assert counts == {"bronze": 2, "rejected": 1, "silver": 1, "invalid": 0}
    assert table(spark, root) == [("a1",), ("a2",), ("b1",)]


def test_rows_of_other_days_late_days_and_wrong_dates(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    write_file(
        landing, "2026-01-16", "a", cell("x", "2026-01-16"), cell("other", "2026-01-15"),
        cell("far", "9999-12-31", "2026-01-16"),
    )
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b1", "2026-01-16")
    write_file(landing, "2026-01-17", "a", cell("next", "2026-01-17"))
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b2", "2026-01-17")
    # a backfill of an old day, with an earlier row of `x`
    write_file(landing, "2026-01-05", "a", cell("old", "2026-01-05"), cell("x", "2026-01-05"))
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b3", "2026-01-05")
    facts = table(spark, root, "fact_events", "event_id", F.col("event_date").cast("string"))
    assert facts == [
        ("next", "2026-01-17"), ("old", "2026-01-05"), ("other", "2026-01-15"), ("x", "2026-01-05")]
    kpis = table(spark, root, "daily_kpis", F.col("event_date").cast("string"), "total_events")
    assert kpis == [("2026-01-05", 2), ("2026-01-15", 1), ("2026-01-17", 1)]
    flags = daily_run.read_silver(spark, root).where("event_id = 'far'")
    assert rows(flags, "quality_flags") == [("invalid_event_date",)]
    days = [str(r[0]) for r in daily_run.read_mart(spark, root, "daily_kpis").select("event_date").collect()]
    assert days == ["2026-01-05", "2026-01-15", "2026-01-17"]
    checks = daily_run.check(spark, root, "2026-01-17")
    assert checks.where("NOT passed").count() == 0

    whole = str(tmp_path / "whole")
    daily_run.run(spark, str(landing), whole, NOW, AS_OF, "all")
    same = LAYERS[2:]
    got, want = snapshot(spark, root), snapshot(spark, whole)
    assert {n: got[n] for n in same} == {n: want[n] for n in same}


def test_a_corrected_file_replaces_its_rows_alone(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    write_file(landing, "2026-01-16", "a", cell("b", "2026-01-16"))
    write_file(landing, "2026-01-17", "a", cell("c", "2026-01-17"), cell("gone", "2026-01-17"))
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b1")
    write_file(landing, "2026-01-16", "a", cell("b", "2026-01-17"))
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b2", "2026-01-16", force=True)
    write_file(landing, "2026-01-17", "a", cell("c", "2026-01-17"))
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b3", "2026-01-17", force=True)
    assert table(spark, root, "fact_events", "event_id", F.dayofmonth("event_date")) == [("b", 17), ("c", 17)]
    assert table(spark, root, "daily_kpis", F.dayofmonth("event_date"), "dau") == [(17, 1)]
    assert rows(daily_run.read_silver(spark, root), "event_id") == [("b",), ("c",)]


@pytest.mark.parametrize("step", ["ledger", "figures"])
def test_a_stopped_run_is_made_good_by_the_next(spark, tmp_path, monkeypatch, step):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    write_file(landing, "2026-01-15", "a", cell("a", "2026-01-15"), cell("m", "2026-01-15"))
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b1")
    write_file(landing, "2026-01-14", "a", cell("m", "2026-01-14"), cell("n", "2026-01-14"))

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        if step == "ledger":  # rows written, files not yet in the ledger
            written = daily_run.write_days
            patch.setattr(daily_run, "write_days", lambda *a, **k: (written(*a, **k), stop()))
        else:  # silver and fact done, the run not
            patch.setattr(daily_run, "replace_daily_kpis", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            daily_run.run(spark, str(landing), root, NOW, AS_OF, "b2")
        if step == "ledger":
            assert daily_run.read_bronze(spark, root).count() == 2
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b2")
    assert table(spark, root, "fact_events", "event_id", F.dayofmonth("event_date")) == [
        ("a", 15), ("m", 14), ("n", 14)]
    assert table(spark, root, "daily_kpis", F.dayofmonth("event_date"), "total_events") == [(14, 2), (15, 1)]


def test_half_valid_day_is_reported_and_one_day_is_pruned(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    write_file(landing, "2026-01-15", "a", cell("a", "2026-01-15"), cell("s", "2026-01-15", event_type="swipe"))
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b1")
    checks = daily_run.check_day(daily_run.read_silver(spark, root), "2026-01-15")
    assert rows(checks.where("check_name = 'valid_ratio'"), "value") == [(50.0,)]
    text = plan(daily_run.read_bronze(spark, root, "2026-01-15"))
    assert "PartitionFilters: [" in text and "event_day" in text.split("PartitionFilters: [")[1].split("]")[0]
