from datetime import date
from decimal import Decimal
from pathlib import Path

from clickmill.operators.kpis import daily_kpis
from clickmill.plans import incremental as I
from clickmill.sources import tables
from helpers import facts, rows

DAYS = [date(2026, 1, d) for d in range(10, 21)]


def events(spark, days=DAYS, **extra):
    return facts(
        spark,
        [{"event_id": f"{d}-{n}", "user_id": f"u{(d.day + n) % 4}", "event_date": d, **extra}
         for d in days for n in range(3)],
    )


def table(spark, path):
    return spark.read.parquet(path)


def test_split_runs_equal_one_run_and_reruns_change_nothing(spark, folder):
    full, path = events(spark), f"{folder}/fact"
    assert I.upsert_facts(full.where("event_date <= '2026-01-15'"), path) is None
    assert I.upsert_facts(full, path) == "2026-01-12"
    want = rows(full, "event_id", "event_date", "user_id")
    assert rows(table(spark, path), "event_id", "event_date", "user_id") == want
    I.upsert_facts(full, path)
    assert rows(table(spark, path), "event_id", "event_date", "user_id") == want
    assert not tables.exists(spark, f"{path}__staged")


def test_late_events_inside_and_outside_the_look_back(spark, folder):
    path = f"{folder}/fact"
    I.upsert_facts(events(spark), path)
    late = events(spark).unionByName(
        facts(spark, [{"event_id": "two", "event_date": date(2026, 1, 18)},
                      {"event_id": "five", "event_date": date(2026, 1, 15)}])
    )
    since = I.upsert_facts(late, path)
    ids = {r[0] for r in rows(table(spark, path), "event_id")}
    assert since == "2026-01-17" and "two" in ids and "five" not in ids
    assert rows(I.missed_events(late, table(spark, path), since)) == [(date(2026, 1, 15), 1)]


def test_changed_event_replaces_its_row_on_an_older_day(spark, folder):
    path = f"{folder}/fact"
    lone = facts(spark, [{"event_id": "moved", "event_date": date(2026, 1, 2)}])
    I.upsert_facts(events(spark).unionByName(lone), path)
    again = facts(spark, [{"event_id": "moved", "event_date": date(2026, 1, 19), "revenue": Decimal("7.00")}])
    I.upsert_facts(again, path)
    got = table(spark, path)
    assert rows(got.where("event_id = 'moved'"), "event_date", "revenue") == [
        (date(2026, 1, 19), Decimal("7.00"))]
    assert got.count() == 3 * len(DAYS) + 1
    assert not tables.exists(spark, f"{path}/event_date=2026-01-02")


def test_vanished_source_rows_stay(spark, folder):
    path = f"{folder}/fact"
    I.upsert_facts(events(spark), path)
    I.upsert_facts(events(spark).where("event_id <> '2026-01-19-0'"), path)
    assert table(spark, path).where("event_id = '2026-01-19-0'").count() == 1


def test_a_run_stopped_after_staging_is_finished_by_the_next(spark, folder):
    path = f"{folder}/fact"
    I.upsert_facts(events(spark), path)
    more = facts(spark, [{"event_id": "x", "event_date": date(2026, 1, 21)}])
    tables.stage(more, path)  # complete, but not moved in
    assert table(spark, path).where("event_id = 'x'").count() == 0
    I.upsert_facts(events(spark), path)
    assert table(spark, path).where("event_id = 'x'").count() == 1


def test_a_run_stopped_between_two_renames_keeps_the_former_day(spark, folder):
    path, day, place = f"{folder}/fact", "event_date=2026-01-20", Path(folder)
    I.upsert_facts(events(spark), path)
    tables.stage(facts(spark, [{"event_id": "x", "event_date": date(2026, 1, 20)}]), path)
    (place / "fact" / day).rename(place / "fact" / f".former-{day}")  # set aside, and then stopped
    assert table(spark, path).where("event_date = '2026-01-20'").count() == 0  # not read twice
    tables.finish_staged(spark, path)
    assert rows(table(spark, path).where("event_date = '2026-01-20'"), "event_id") == [("x",)]
    assert not list((place / "fact").glob(".former-*")) and not (place / "fact__staged").exists()


def test_a_run_stopped_while_staging_leaves_the_table(spark, folder):
    path = f"{folder}/fact"
    I.upsert_facts(events(spark), path)
    tables.write_table(events(spark).limit(1), f"{path}__staged/touched")  # no rows staged yet
    I.upsert_facts(events(spark), path)
    assert table(spark, path).count() == 3 * len(DAYS)


def test_daily_kpis_day_by_day_equal_a_full_build(spark, folder):
    full, path = events(spark), f"{folder}/kpis"
    for last in ("2026-01-13", "2026-01-16", "2026-01-20"):
        I.update_daily_kpis(full.where(f"event_date <= '{last}'"), path)
    want = daily_kpis(full)
    assert rows(table(spark, path), *want.columns) == rows(want)


def test_days_before_the_cutoff_are_untouched(spark, folder):
    path = f"{folder}/kpis"
    I.update_daily_kpis(events(spark), path)
    I.update_daily_kpis(events(spark, event_type="click"), path)
    clicks = dict(rows(table(spark, path), "event_date", "clicks"))
    assert clicks[date(2026, 1, 16)] == 0 and clicks[date(2026, 1, 17)] == 3


def test_writers_replace_their_days_only(spark, folder):
    path = f"{folder}/t"
    df = events(spark).select("event_id", "event_date")
    assert tables.read_table(spark, path) is None
    assert tables.write_days(df, path) == 33
    assert tables.write_days(df.where("event_date = '2026-01-12'"), path) == 3
    assert table(spark, path).count() == 33
