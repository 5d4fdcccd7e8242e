from __future__ import annotations

import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewarden.functions import calendar as cal
from tablewarden.operators import privacy as p
from tablewarden.operators.privacy import SubjectLink

LINKS = {
    "person": SubjectLink("pid"),
    "orders": SubjectLink("who"),
    "items": SubjectLink("oid", parent="orders", parent_key="oid"),
}
D = dt.date


@pytest.fixture
def tables(spark):
    return {
        "person": spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "pid bigint, name string"),
        "orders": spark.createDataFrame([(10, 1), (11, 1), (12, 2), (13, None)], "oid bigint, who bigint"),
        "items": spark.createDataFrame([(10, "x"), (10, "y"), (12, "z"), (99, "q")], "oid bigint, sku string"),
    }


@pytest.fixture
def tickets(spark):
    return spark.createDataFrame(
        [("T1", 1), ("T2", 7), ("", 2), (None, 3)], "ticket string, subject_id bigint")


@pytest.mark.parametrize("few", [True, False])
def test_erase(spark, tables, rows, few, monkeypatch):
    if not few:
        monkeypatch.setattr(p, "small_or_shuffled", lambda df: df)
    gone = spark.createDataFrame([(1,), (1,), (None,)], "subject_id bigint")
    left = p.erase(tables, gone, LINKS)
    assert list(left) == ["items", "orders", "person"]
    assert rows(left["person"]) == [(2, "b"), (3, "c")]
    assert rows(left["orders"]) == [(12, 2), (13, None)]
    assert rows(left["items"]) == [(12, "z"), (99, "q")]


@pytest.mark.parametrize("few", [True, False])
def test_erasure_audit_needs_a_ticket_and_reports_zero(tables, tickets, rows, few, monkeypatch):
    monkeypatch.setattr(p, "is_small", lambda df: few)
    assert rows(p.erasure_audit(tables, tickets, LINKS)) == [
        ("T1", "items", 1, 2), ("T1", "orders", 1, 2), ("T1", "person", 1, 1),
        ("T2", "items", 7, 0), ("T2", "orders", 7, 0), ("T2", "person", 7, 0)]


def test_subject_access(spark, tables):
    who = spark.createDataFrame([(1,), (2,)], "subject_id bigint")
    got = p.subject_access(tables, who, LINKS).collect()
    assert len(got) == 2 + 3 + 3
    items = [json.loads(r.record) for r in got if r.table_name == "items" and r.subject_id == 1]
    assert sorted(i["sku"] for i in items) == ["x", "y"]


def test_overdue(spark, rows):
    # Monday 1 January 2024; 15 business days later is Monday 22 January.
    df = spark.createDataFrame(
        [("ok", 1, D(2024, 1, 1), D(2024, 1, 22)), ("late", 1, D(2024, 1, 1), D(2024, 1, 23)),
         ("open", 1, D(2024, 1, 1), None)],
        "ticket string, subject_id bigint, opened date, confirmed date")
    late = p.erasure_overdue(df, D(2024, 1, 24)).select("ticket", "business_days")
    assert rows(late) == [("late", 16), ("open", 17)]
    holiday = p.erasure_overdue(df, D(2024, 1, 24), holidays=[D(2024, 1, 3), D(2024, 1, 6)])
    assert rows(holiday.select("ticket", "business_days")) == [("open", 16)]


def test_retention(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 23, 59)), (2, dt.datetime(2024, 1, 2)), (3, None)], "id int, ts timestamp_ntz")
    # Due on 11 January: not yet past on the 11th.
    assert p.retention_due(df, "ts", D(2024, 1, 11), 10).count() == 0
    assert [r.id for r in p.retention_due(df, "ts", D(2024, 1, 12), 10).collect()] == [1]
    tagged = df.withMetadata("id", {"retention_days": 10}).withMetadata("ts", {"retention_days": 20})
    assert p.shortest_retention(tagged.schema) == 10
    assert p.retention_due(tagged, "ts", D(2024, 1, 12)).count() == 1
    with pytest.raises(ValueError):
        p.retention_due(df, "ts", D(2024, 1, 12))


def test_retention_filter_reaches_the_scan(spark, tmp_path):
    spark.range(5).select(F.timestamp_seconds("id").alias("ts")).write.parquet(str(tmp_path / "t"))
    due = p.retention_due(spark.read.parquet(str(tmp_path / "t")), "ts", D(2024, 1, 1), 1)
    assert "LessThan(ts" in due._jdf.queryExecution().executedPlan().toString()


def test_log_retention(spark):
    df = spark.createDataFrame([(D(2017, 2, 27),), (D(2017, 2, 28),), (D(2023, 1, 1),)], "d date")
    assert p.log_retention_due(df, "d", D(2024, 2, 29), "system_access").count() == 1
    assert p.log_retention_due(df, "d", D(2024, 2, 29), "data_lineage").count() == 2


def test_residency(spark, rows):
    df = spark.createDataFrame(
        [("s3://a.eu-west-1/x us-gov-east-1 eu-west-1",), ("ap-southeast-1 only",), ("ap-northeast-2",), ("none",)], "t string")
    found = p.residency_violations(df, "t").select("regions")
    assert rows(found) == [(["ap-northeast-2"],), (["eu-west-1", "us-gov-east-1"],)]


dates = st.dates(D(1990, 1, 1), D(2035, 1, 1))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(dates, st.integers(0, 900)), min_size=20, max_size=40), st.lists(dates, max_size=40))
def test_business_days_by_counting(spark, spans, holidays):
    pairs = [(a, a + dt.timedelta(days=n), n % 17 + 1) for a, n in spans]
    holidays = holidays + [a + dt.timedelta(days=3) for a, _, _ in pairs[:5]]

    def count(a, b, off=()):
        return sum(
            1 for i in range(1, (b - a).days + 1)
            if (a + dt.timedelta(days=i)).weekday() < 5 and a + dt.timedelta(days=i) not in off)

    a, b = F.col("a"), F.col("b")
    got = spark.createDataFrame(pairs, "a date, b date, n int").select(
        "a", "b", cal.business_days(a, b).alias("plain"), cal.business_days(a, b, holidays).alias("off"),
        cal.add_business_days(a, 15).alias("later"), cal.add_business_days(a, 15, holidays).alias("later_off"),
    ).collect()
    for r in got:
        assert r.plain == count(r.a, r.b) and r.off == count(r.a, r.b, holidays)
        assert count(r.a, r.later) == 15 and r.later.weekday() < 5
        assert count(r.a, r.later_off, holidays) == 15
        assert r.later_off.weekday() < 5 and r.later_off not in holidays


def test_review_dates(spark):
    given_days = [D(2024, 1, 1), D(2024, 1, 2), D(2024, 4, 1), D(2024, 12, 31), D(2023, 10, 2), D(2023, 10, 3)]
    want = [D(2024, 1, 1), D(2024, 4, 1), D(2024, 4, 1), D(2025, 1, 6), D(2023, 10, 2), D(2024, 1, 1)]
    df = spark.createDataFrame([(d,) for d in given_days], "d date")
    assert [r.r for r in df.select(cal.next_review_date(F.col("d")).alias("r")).collect()] == want
