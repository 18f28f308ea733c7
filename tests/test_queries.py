"""Every registered query against its SQL on DuckDB, and what its plan must not contain."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from clickmill.plans.oracles import ORACLES as SQL
from clickmill.plans.queries import REGISTRY as QUERIES
from helpers import plan

SF = "/root/testdata/sf0.001"
WRITES = {n for n in QUERIES if n.startswith("stream_") or "incremental" in n or n.endswith("_by_day")}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(columns, records):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr(tuple(r[i] for i in order)) for r in records)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    want = duck.execute(SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, df.collect()) == canonical(columns, want.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in text


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "event_date" and df.count() > 0
