from datetime import date

import pytest

from clickmill.operators import quality as Q
from helpers import rows, silver

DAY = date(2026, 1, 15)


def checks(spark, events, day="2026-01-15"):
    return {r[0]: tuple(r)[1:] for r in Q.check_day(silver(spark, events), day).collect()}


def test_a_good_day(spark):
    got = checks(spark, [{"event_date": DAY}, {"event_date": DAY, "is_valid": False}, {"event_date": date(2026, 1, 1)}])
    assert got == {
        "row_count": (2.0, "report", True),
        "null_event_ids": (0.0, "fail", True),
        "valid_ratio": (50.0, "report", True),
        "duplicate_check": (0.0, "warn", True),
    }


def test_duplicates_warn_and_null_ids_fail(spark):
    events = [{"event_id": i, "event_date": DAY} for i in ("a", "a", "a", "b", None)]
    got = checks(spark, events)
    assert got["duplicate_check"] == (3.0, "warn", False)
    assert got["null_event_ids"] == (1.0, "fail", False)
    with pytest.raises(Q.QualityError, match="null_event_ids"):
        Q.enforce(Q.check_day(silver(spark, events), "2026-01-15"))
    Q.enforce(Q.check_day(silver(spark, events[:4]), "2026-01-15"))


def test_an_empty_day_warns_and_an_empty_table_fails(spark):
    got = checks(spark, [{"event_date": DAY}], "2026-01-16")
    assert got["row_count"] == (0.0, "warn", False)
    assert [got[c][1] for c in ("null_event_ids", "valid_ratio", "duplicate_check")] == ["skipped"] * 3
    assert checks(spark, [])["row_count"] == (0.0, "fail", False)


def test_constraints(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("a", None), (None, "x"), (None, "z")], "id string, kind string"
    )
    rules = Q.Rules(unique=["id"], not_null=["id", "kind"], accepted={"kind": ["x", "y"]})
    assert rows(Q.check_table("t", df, rules)) == [
        ("t", "id", "not_null", 2),
        ("t", "id", "unique", 1),
        ("t", "kind", "accepted_values", 1),
        ("t", "kind", "not_null", 1),
    ]
