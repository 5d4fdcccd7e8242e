from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablewarden.functions.text import audit_key
from tablewarden.operators import audit, ordered
from tablewarden.sources.tables import append_audit, dump_csv, in_order, read_audit, read_scope, report_json

T0 = dt.datetime(2024, 5, 1, 12)


def log(spark, *entries):
    rows = [(i, T0 + dt.timedelta(hours=h), b, t, s) for i, (h, b, t, s) in enumerate(entries)]
    return spark.createDataFrame(rows, "id int, ts timestamp, bundle string, target string, git_sha string")


def flags(df):
    return {r.id: (r.previous_sha, r.is_rollback) for r in df.collect()}


@pytest.mark.parametrize("limit", [2, 1_000_000])
def test_rollback_is_an_older_sha_after_another(spark, limit):
    df = log(spark, (0, "x", "prod", "A"), (1, "x", "prod", "B"), (2, "x", "prod", "A"), (3, "x", "prod", "A"),
             (0, "x", "dev", "A"), (4, "x", "prod", None), (5, "x", "prod", "C"))
    assert flags(audit.deploy_timeline(df, sequence="id", max_rows=limit)) == {
        0: (None, False), 1: ("A", False), 2: ("B", True), 3: ("A", False), 4: (None, False),
        5: ("A", False), 6: (None, False)}
    assert audit.rollbacks(audit.deploy_timeline(df, sequence="id")).count() == 1


@pytest.mark.parametrize("max_rows", [0, 100, 1_000_000])
@pytest.mark.parametrize("hot", [0, 2000])
def test_previous_row_over_partition_seams(spark, hot, max_rows):
    """One key owns nearly everything, with equal timestamps; compared with a plain loop."""
    entries = [("k", i // 50, i, (i * 7919) % 13) for i in range(hot)]
    entries += [(f"c{i % 40}", i // 40, 10_000 + i, i % 5) for i in range(400)]
    entries += [(None, 1, 99_999, 1), (None, 2, 100_000, 2)]
    df = spark.createDataFrame(entries, "k string, ts int, id int, v int").repartition(7)
    got = {r.id: r.before for r in ordered.with_previous(
        df, ["k"], ["ts", "id"], {"before": "v"}, max_rows).collect()}
    want, last = {}, {}
    for k, ts, i, v in sorted(entries, key=lambda e: (e[1], e[2])):
        want[i], last[k] = last.get(k), v
    assert got == want


def test_latest_by_key_limits_before_the_shuffle(spark, rows):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    newest = ordered.latest_by_key(df, ["k"], ["v"])
    assert newest._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert rows(newest) == [(0, 999), (1, 997), (2, 998)]


def test_bake(spark, rows):
    df = log(spark, (0, "x", "staging", "A"), (23, "x", "prod", "A"), (24, "x", "prod", "A"),
             (25, "x", "prod", "B"), (30, "x", "staging", "B"), (40, "y", "prod", "A"), (50, "x", "staging", "A"))
    got = audit.bake_violations(df).select("id", "reason")
    assert rows(got) == [(1, "short_bake"), (3, "not_staged"), (5, "not_staged")]


def test_duties_and_tickets(spark):
    df = spark.createDataFrame(
        [(1, "prod", "a", "b", "CHG-1234"), (2, "prod", "a", "a", ""), (3, "dev", "a", "a", "CHG-"),
         (4, "prod", "a", None, None), (5, "prod", None, None, "xCHG-1"), (6, "prod", None, "b", "CHG-1 ")],
        "id int, target string, author string, approver string, change_ticket string")
    assert sorted(r.id for r in audit.sod_violations(df).collect()) == [2, 4, 5]
    assert sorted(r.id for r in audit.ticket_violations(df).collect()) == [2, 3, 4, 5, 6]


def test_sink_appends_below_target_and_date(spark, tmp_path):
    df = log(spark, (0, "x", "prod", "a" * 20), (15, "x", "dev", "B")).select(
        "ts", "bundle", "target", "git_sha", *[F.lit("").alias(c) for c in
        ("actor", "ci_job_url", "ci_pipeline_id", "mr_iid", "change_ticket")])
    path = str(tmp_path / "audit")
    append_audit(df, path)
    append_audit(df, path)
    assert (tmp_path / "audit" / "target=prod" / "date=2024-05-01").is_dir()
    back = read_audit(spark, path)
    assert back.count() == 4
    pruned = back.filter("target = 'dev'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(target" in pruned
    key = df.select(audit_key(F.col("target"), F.col("ts"), F.col("bundle"), F.col("git_sha")).alias("k"))
    assert key.first().k == "prod/2024-05-01/x-aaaaaaaaaaaa.json"


def test_dump_scope_and_json(spark, tmp_path, rows):
    df = spark.createDataFrame([("a", 'q"x,y'), ("b", None)], "user_email string, cost_centre string")
    path = dump_csv(df, str(tmp_path), "2024-01-01", "scope")
    assert path.endswith("/2024-01-01/scope.csv")
    assert [r.user_email for r in in_order(df, "cost_centre").collect()] == ["b", "a"]
    assert [r.user_email for r in in_order(df).collect()] == ["a", "b"]
    (tmp_path / "seed.csv").write_text("user_email,cost_centre\nalice@x,FINANCE\n")
    assert rows(read_scope(spark, str(tmp_path / "seed.csv"))) == [("alice@x", "FINANCE")]
    assert rows(report_json(df)) == [
        ('{"user_email":"a","cost_centre":"q\\"x,y"}',), ('{"user_email":"b","cost_centre":null}',)]
