"""Physical plans: what reaches the files, and how often rows are shuffled."""

import re
from datetime import date

import pytest

from clickmill.operators import activity, kpis, quality, retention, users
from clickmill.operators.facts import fact_events, stg_events
from clickmill.plans import incremental
from clickmill.schemas import SILVER
from clickmill.sources import tables
from helpers import facts, plan, silver


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stored")
    days = [date(2026, 1, d) for d in range(1, 29)]
    tables.write_days(facts(spark, [{"event_id": str(d), "event_date": d} for d in days]), f"{folder}/fact")
    tables.write_days(silver(spark, [{"event_id": str(d), "event_date": d} for d in days]), f"{folder}/silver")
    return spark.read.parquet(f"{folder}/fact"), spark.read.schema(SILVER).parquet(f"{folder}/silver")


@pytest.fixture
def large(spark):
    """Plans as for tables too large to broadcast."""
    sizes = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {key: spark.conf.get(key) for key in sizes}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def scans(text):
    return re.findall(r"FileScan parquet \[(.*?)\].*?PartitionFilters: \[(.*?)\], PushedFilters", text)


def exchanges(text):
    return len(re.findall(r"Exchange (hash|range|Single|Round)", text))


def test_recent_kpis_read_recent_partitions_and_few_columns(stored):
    fact, _ = stored
    found = scans(plan(kpis.daily_kpis(fact, since="2026-01-20")))
    assert len(found) == 3
    assert all("event_date" in filters and ">=" in filters for _, filters in found)
    assert sum("2026-01-14" in f for _, f in found) == 1  # six days back for the weekly users
    assert sorted(len(c.split(",")) for c, _ in found)[0] == 2


def test_incremental_source_is_pruned(stored):
    _, source = stored
    new = fact_events(stg_events(source)).where("event_date >= DATE'2026-01-20'")
    assert all(">=" in filters for _, filters in scans(plan(new)))


def test_daily_check_reads_one_partition(stored):
    _, source = stored
    text = plan(quality.check_day(source, "2026-01-20"))
    columns = {c: f for c, f in scans(text)}
    assert any("= 2026-01-20" in f for f in columns.values())
    # the count of all rows reads no data column
    assert any(re.fullmatch(r"(event_date#\d+)?", c) for c, f in columns.items() if "2026" not in f)


def test_weekly_users_and_retention_shuffle_user_days_only(stored):
    fact, _ = stored
    days = activity.user_days(fact)
    for df in (activity.rolling_active_users(days), retention.retention(days)):
        text = plan(df)
        assert exchanges(text) == 3 and "Expand" not in text
        assert [len(c.split(",")) for c, _ in scans(text)] == [2]


def test_user_dimension_joins_without_another_shuffle(stored, large):
    _, source = stored
    text = plan(users.dim_users(stg_events(source), "2026-02-01"))
    assert exchanges(text) == 3 and "SortMergeJoin" in text


def test_upsert_filters_the_target_before_its_shuffle(spark, stored, large, tmp_path):
    fact, source = stored
    new = fact_events(stg_events(source)).where("event_date >= DATE'2026-01-25'")
    incremental.batch_ids(new.unionByName(new), f"{tmp_path}/t")
    ids = incremental.read_batch_ids(spark, f"{tmp_path}/t", "2026-01-25")
    assert ids.count() == 4  # copies are combined
    text = plan(incremental.rows_with_ids(fact, ids))
    assert "might_contain" in text
