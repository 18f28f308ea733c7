"""The event index, versions, user parts, waiting list and refusals behind the daily job."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from clickmill.operators import activity, kpis, user_parts, users
from clickmill.operators.facts import stg_events
from clickmill.operators.funnel import funnel_analysis
from clickmill.operators.quality import QualityError
from clickmill.plans import daily_run, incremental
from clickmill.sources import event_index, tables, versions
from helpers import facts, plan, rows, silver
from test_daily_run import AS_OF, LAYERS, NOW, cell, deliver, write_file
from test_plans import exchanges, large  # noqa: F401

MARTS = LAYERS[2:]


def read(spark, root, name):
    """All cells as text."""
    table = tables.read_table(spark, f"{root}/{name}")
    return rows(table.select([F.col(c).cast("string") for c in sorted(table.columns)]).fillna("-"))


def stop(*args, **kwargs):
    raise RuntimeError("stopped")


# ---- event index ----


def test_places_are_read_from_their_buckets_without_a_shuffle_of_the_index(spark, folder, large):  # noqa: F811
    days = [{"event_id": f"e{i}", "event_date": date(2026, 1, 1 + i % 20)} for i in range(200)]
    for part in (days[:150], days[100:]):
        event_index.append_places(spark, f"{folder}/index", facts(spark, part).withColumn("event_day", F.lit("x")))
    ids = spark.createDataFrame([("e5",), ("e120",), ("none",)], "event_id string")
    found = event_index.places_of(spark, f"{folder}/index", ids)
    assert rows(found.distinct(), "event_id") == [("e120",), ("e5",)]
    text = plan(found)
    index = text[text.index("event_index") - 2000 : text.index("event_index")]
    assert exchanges(text) == 1 and "Bucketed: true" in text and "Exchange" not in index.split("SortMergeJoin")[-1]

    event_index.compact_places(spark, f"{folder}/index", buckets=32)
    again = event_index.read_places(spark, f"{folder}/index")
    assert again.count() == 200 and "SelectedBucketsCount: 32 out of 32" in plan(again.groupBy("event_id").count())


def test_places_of_a_load_come_from_the_index_alone(spark, tmp_path, monkeypatch):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    deliver(landing, "2026-01-15", "a", "b")
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b1")
    deliver(landing, "2026-01-16", "b", "c")
    daily_run.load(spark, str(landing), root, NOW, "b2")
    seen = []
    found = daily_run.places_of
    monkeypatch.setattr(daily_run, "places_of", lambda *a: seen.append(plan(found(*a))) or found(*a))
    change = daily_run.pending(spark, root, NOW)
    assert [str(d) for d in change.days] == ["2026-01-15", "2026-01-16"]
    assert len(seen) == 1 and "/bronze/" not in seen[0] and "event_index" in seen[0]


def test_tables_without_an_index_get_one(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    deliver(landing, "2026-01-15", "a", "b")
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b1")
    for name in ("event_index", "user_values", "user_days", "user_totals"):
        tables.drop(spark, f"{root}/{name}")
    deliver(landing, "2026-01-16", "b", "c")
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b2")
    whole = str(tmp_path / "whole")
    daily_run.run(spark, str(landing), whole, NOW, AS_OF, "all")
    assert {n: read(spark, root, n) for n in MARTS} == {n: read(spark, whole, n) for n in MARTS}


# ---- user parts ----


def events(spark):
    kinds = ["page_view", "click", "add_to_cart", "purchase", "cashback_earned", "refund"]
    return [
        {"event_id": str(i), "user_id": f"u{i % 13}", "event_date": date(2026, 1, 1 + i * i % 25), "event_type": kinds[i % 6],
         "session_id": f"s{i % 31}", "product_id": f"p{i % 11}", "device_type": ["mobile", "desktop", "tablet", "tv"][i % 4],
         "browser": f"b{i % 3}", "city": None if i % 5 == 0 else f"c{i % 4}", "revenue": i % 7, "cashback_amount": i % 3}
        for i in range(400)
    ]


def test_figures_merged_from_parts_equal_those_of_the_events(spark):
    from decimal import Decimal

    data = [{**e, "revenue": Decimal(e["revenue"]), "cashback_amount": Decimal(e["cashback_amount"])} for e in events(spark)]
    fact, days = facts(spark, data), [date(2026, 1, 10), date(2026, 1, 17)]
    by_day, values = user_parts.user_days(fact), user_parts.user_values(fact)
    assert rows(user_parts.daily_kpis(by_day, values)) == rows(kpis.daily_kpis(fact))
    assert rows(user_parts.daily_kpis(by_day, values, days)) == rows(kpis.daily_kpis(fact, days=days))
    totals = user_parts.user_totals(by_day, values)
    text = [F.col(c).cast("string") for c in users.dim_users(fact, AS_OF).columns]
    cells = lambda df: rows(df.select(text).fillna("-"))
    assert cells(user_parts.dim_users(totals, AS_OF)) == cells(users.dim_users(fact, AS_OF))
    assert rows(user_parts.funnel_analysis(totals)) == rows(funnel_analysis(fact))
    estimates = activity.weekly_estimates(activity.daily_sketches(fact))
    assert rows(estimates) == rows(activity.rolling_active_users(activity.user_days(fact)))  # few users: exact


def test_daily_figures_read_no_fact_and_untouched_users_are_not_merged_again(spark, folder, large):  # noqa: F811
    fact = facts(spark, [{"event_id": str(i), "user_id": f"u{i}"} for i in range(20)])
    for name, df in (("fact", fact), ("days", user_parts.user_days(fact)), ("values", user_parts.user_values(fact))):
        df.write.parquet(f"{folder}/{name}")
    stored, by_day, values = (spark.read.parquet(f"{folder}/{n}") for n in ("fact", "days", "values"))
    assert "/fact" not in plan(user_parts.daily_kpis(by_day, values))
    built = plan(user_parts.user_days(stored)) + plan(user_parts.user_values(stored))
    assert built.count("FileScan") == 2  # all that a day's figures take from the fact
    user_parts.user_totals(by_day, values).write.parquet(f"{folder}/totals")
    target = spark.read.parquet(f"{folder}/totals")
    touched = spark.createDataFrame([("u3",), ("new",)], "user_id string")
    merged = incremental.merged_totals(by_day, values, target, touched)
    text = plan(merged)
    carried, fresh = text.split("LeftAnti")[0], text.split("LeftAnti")[1]
    kept = fresh[: fresh.index("LeftSemi")]
    assert "Union" in carried and "/totals" in kept
    assert "Aggregate" not in kept.split("Project")[0].split("HashAggregate")[0]
    assert fresh.count("LeftSemi") == 2  # both parts are narrowed to the touched users before they are merged
    assert rows(merged, "user_id") == rows(target, "user_id")


def test_a_user_who_lost_all_events_leaves_the_dimension(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    write_file(landing, "2026-01-15", "a", cell("x", "2026-01-15", user_id="old"), cell("y", "2026-01-15", user_id="stays"))
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b1")
    write_file(landing, "2026-01-15", "a", cell("x", "2026-01-14", user_id="new"), cell("y", "2026-01-15", user_id="stays"))
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b2", force=True)
    assert [r[0] for r in rows(tables.read_table(spark, f"{root}/dim_users"), "user_id")] == ["new", "stays"]


@pytest.mark.parametrize("step", ["replace_days", "replace_user_totals"])
def test_a_run_that_stops_among_the_parts_is_made_good(spark, tmp_path, monkeypatch, step):
    landing, root, whole = tmp_path / "landing", str(tmp_path / "root"), str(tmp_path / "whole")
    write_file(landing, "2026-01-15", "a", cell("x", "2026-01-15", user_id="old"), cell("y", "2026-01-15"))
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b1")
    write_file(landing, "2026-01-16", "a", cell("x", "2026-01-14", user_id="new"), cell("z", "2026-01-16"))
    with monkeypatch.context() as patch:
        patch.setattr(daily_run, step, stop)
        with pytest.raises(RuntimeError, match="stopped"):
            daily_run.run(spark, str(landing), root, NOW, AS_OF, "b2")
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b2")
    daily_run.run(spark, str(landing), whole, NOW, AS_OF, "all")
    assert {n: read(spark, root, n) for n in MARTS} == {n: read(spark, whole, n) for n in MARTS}


# ---- rows whose time has not come ----


def test_rows_dated_after_now_are_taken_up_when_their_time_has_come(spark, tmp_path):
    landing, root, whole = tmp_path / "landing", str(tmp_path / "root"), str(tmp_path / "whole")
    write_file(
        landing, "2026-01-15", "a", cell("a", "2026-01-15"), cell("late", "2026-01-15", "2026-01-16"),
        cell("day", "2026-01-16", "2026-01-15"), cell("never", "2026-01-15", "2126-01-01"),
    )
    first = daily_run.run(spark, str(landing), root, "2026-01-15 23:00:00", AS_OF, "b1")
    assert first["invalid"] == 3 and read(spark, root, "waiting")[0][1] == "day"
    write_file(landing, "2026-01-16", "b", cell("b", "2026-01-15"))
    daily_run.run(spark, str(landing), root, "2026-01-16 09:00:00", AS_OF, "b2")
    assert [r[0] for r in rows(tables.read_table(spark, f"{root}/fact_events"), "event_id")] == ["a", "b", "day"]
    moved = daily_run.run(spark, str(landing), root, "2026-01-16 10:00:00", AS_OF, "b3")  # no new file at all
    assert moved == {"bronze": 0, "rejected": 0, "silver": 1, "invalid": 0}
    daily_run.run(spark, str(landing), whole, "2026-01-16 10:00:00", AS_OF, "all")
    assert {n: read(spark, root, n) for n in MARTS} == {n: read(spark, whole, n) for n in MARTS}
    assert [r[1] for r in read(spark, root, "waiting")] == ["never"]
    again = daily_run.run(spark, str(landing), root, "2026-01-16 10:00:00", AS_OF, "b4")
    assert again == {"bronze": 0, "rejected": 0, "silver": 0, "invalid": 0}


# ---- refusals ----


def test_rows_without_an_id_are_refused_and_the_old_table_stays(spark, folder):
    path = f"{folder}/fact"
    days = [date(2026, 1, 15)]
    assert incremental.replace_events(facts(spark, [{"event_id": "a"}]), path, None, [])["rows"] == 1
    bad = facts(spark, [{"event_id": "b"}, {"event_id": None}])
    ids = spark.createDataFrame([("a",), ("b",)], "event_id string")
    for touched in (ids, None):
        with pytest.raises(QualityError):
            incremental.replace_events(bad, path, touched, days)
        assert rows(tables.read_table(spark, path), "event_id") == [("a",)]
        assert not tables.exists(spark, f"{path}__staged")
    counted = incremental.replace_events(
        facts(spark, [{"event_id": "b"}]), path, ids, days, counts={"views": F.count_if(F.col("event_type") == "page_view")}
    )
    assert counted == {"rows": 1, "views": 1}


# ---- versions ----


def test_readers_get_one_whole_version_at_every_step_of_a_publish(spark, folder, monkeypatch):
    versions.keep_versions(spark, folder)
    path = f"{folder}/fact"
    one = [{"event_id": f"{d}-{n}", "event_date": date(2026, 1, d)} for d in (1, 2, 3) for n in range(2)]
    tables.stage(facts(spark, one), path, sort=("user_id",))
    assert tables.read_table(spark, path) is None and not tables.has_table(spark, path)
    tables.finish_staged(spark, path)
    seen = []

    def look(*args):
        seen.append(tuple(sorted(r[0] for r in tables.read_table(spark, path).select("event_id").collect())))

    def looking(f):
        def step(*args, **kwargs):
            look()
            out = f(*args, **kwargs)
            look()
            return out

        return step

    for name in ("write_partitions", "drop", "require_marker", "clean_up"):
        monkeypatch.setattr(versions, name, looking(getattr(versions, name)))
    two = facts(spark, [{"event_id": "new", "event_date": date(2026, 1, 2)}])
    tables.stage(two, path, [date(2026, 1, 2), date(2026, 1, 3)])
    tables.finish_staged(spark, path)
    look()
    old, new = tuple(sorted(e["event_id"] for e in one)), ("1-0", "1-1", "new")
    assert len(seen) > 8 and seen == [old] * seen.index(new) + [new] * (len(seen) - seen.index(new))
    assert rows(versions.read_version(spark, path, version=1), "event_id") == [(e,) for e in old]  # still there


def test_old_versions_go_and_a_stopped_publish_is_finished_or_given_up(spark, folder, monkeypatch):
    versions.keep_versions(spark, folder)
    path = f"{folder}/users"
    for i in range(4):
        tables.replace_whole(spark.range(i + 1), path)
    assert versions.current(spark, path) == 4 and sorted(versions.children(spark, f"{path}/data")) == ["v=3", "v=4"]
    tables.stage_whole(spark.range(9), path)  # complete, but not published
    tables.finish_staged(spark, path)
    assert tables.read_table(spark, path).count() == 9
    tables.stage_whole(spark.range(1), path)
    tables.drop_staged(spark, path)
    tables.finish_staged(spark, path)
    assert tables.read_table(spark, path).count() == 9


def test_the_whole_job_in_versions_equals_the_job_in_folders(spark, tmp_path):
    landing, root, plain = tmp_path / "landing", str(tmp_path / "root"), str(tmp_path / "plain")
    deliver(landing, "2026-01-15", "a", "b")
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b1", versioned=True)
    deliver(landing, "2026-01-16", "b", "c")
    write_file(landing, "2026-01-17", "d", cell("a", "2026-01-17"))
    daily_run.run(spark, str(landing), root, NOW, AS_OF, "b2")
    daily_run.run(spark, str(landing), plain, NOW, AS_OF, "all")
    assert {n: read(spark, root, n) for n in MARTS} == {n: read(spark, plain, n) for n in MARTS}
    assert versions.current(spark, f"{root}/fact_events") == 2
    assert daily_run.check(spark, root, "2026-01-16").where("NOT passed").count() == 0
    assert rows(daily_run.read_mart(spark, root, "funnel_analysis")) == rows(daily_run.read_mart(spark, plain, "funnel_analysis"))


def test_stg_rows_of_silver_are_those_the_fact_takes(spark):
    held = silver(spark, [{"event_id": "a"}, {"event_id": "b", "is_valid": False}])
    assert rows(stg_events(held), "event_id") == [("a",)]
