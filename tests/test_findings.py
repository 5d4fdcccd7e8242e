"""Cases that sizes, time zones and odd inputs used to decide."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablewarden.context import Caller, Env
from tablewarden.functions import calendar, masks, text
from tablewarden.operators import audit, privacy
from tablewarden.streaming import sync


@pytest.mark.parametrize("sequence", [None, "n"])
def test_timeline_is_the_same_for_any_limit(spark, sequence):
    at = lambda h: dt.datetime(2024, 1, 1, h)
    rows = [(None, "prod", s, at(h), n) for n, (h, s) in enumerate(zip((1, 2, 3, 4), "ABAB"))]
    rows += [("b", "prod", s, at(h), n) for n, (h, s) in enumerate([(1, "A"), (1, "B"), (1, "A"), (2, "B")])]
    rows += [("c", None, None, at(1), 1), ("c", None, "A", at(2), 2), ("c", None, None, at(3), 3)]
    frame = spark.createDataFrame(
        rows, "bundle string, target string, git_sha string, ts timestamp, n int"
    )
    few, many = (
        sorted(map(tuple, audit.deploy_timeline(frame, sequence=sequence, max_rows=m).collect()), key=str)
        for m in (1, 10**6)
    )
    assert few == many
    assert [r[-1] for r in sorted((r for r in many if r[0] is None), key=lambda r: r[3])] == [False, False, True, True]


def test_lag_counts_fractions(spark):
    at = lambda us: spark.createDataFrame(
        [(dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=us),)], "ts timestamp")
    late = sync.sync_lag(at(300_900_000), at(0), "ts", "ts", "TRIGGERED").first()
    assert (late.lag_seconds, late.alert) == (300, True)
    assert not sync.sync_lag(at(300_000_000), at(0), "ts", "ts", "TRIGGERED").first().alert


def test_regions_are_whole_tokens(spark):
    texts = ["in cn-north-1 now", "ap-southeast-17", "campus-east-1", "ap-southeast-1", "x us-gov-west-1."]
    found = privacy.residency_violations(
        spark.createDataFrame([(t,) for t in texts], "t string"), "t").collect()
    assert [r.regions for r in found] == [["cn-north-1"], ["ap-southeast-17"], ["us-gov-west-1"]]


def test_no_days_with_and_without_holidays(spark):
    days = [dt.date(2024, 5, d) for d in range(1, 15)]
    frame = spark.createDataFrame([(d,) for d in days], "d date")
    far = [dt.date(2023, 1, 2)]
    got = frame.select(calendar.add_business_days(F.col("d"), 0).alias("a"),
                       calendar.add_business_days(F.col("d"), 0, far).alias("b")).collect()
    assert all(r.a == r.b for r in got)


def test_dates_of_audits_are_utc(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Singapore")
    try:
        row = spark.sql("select timestamp'2024-03-01 20:00:00 UTC' as ts").select(
            text.audit_key(F.lit("prod"), F.col("ts"), F.lit("b"), F.lit("0123456789abcdef")).alias("k"))
        assert row.first().k == "prod/2024-03-01/b-0123456789ab.json"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_filter_takes_its_value_by_place(spark):
    scope = spark.createDataFrame([("a@x", "7")], "user_email string, cost_centre string")
    env = Env("dev")
    caller = Caller("a@x", frozenset({env.group("finance_team")}))
    frame = spark.createDataFrame([("7",), ("8",)], "dept string")
    seen = masks.filter_by_cost_centre(caller, env, scope, "dept")
    assert [r.dept for r in frame.filter(seen).collect()] == ["7"]
