from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import digest, quality
from tablewarden.operators import reconcile as r

KEY, METRICS = ["id"], ["amount"]


@pytest.fixture
def legacy(spark):
    return spark.range(2000).select(
        "id", (F.col("id") % 100 + 0.5).alias("amount"), F.lit("x").alias("note")
    )


def failed(checks):
    return sorted({row.check_name for row in checks.filter("NOT passed").collect()})


def reconcile(legacy, new):
    checks = r.reconcile(legacy, new, KEY, METRICS)
    assert r.verdict(checks).first().passed == (not failed(checks))
    return failed(checks)


def test_identical(legacy):
    assert reconcile(legacy, legacy) == []


def test_one_row_lost_is_inside_the_tolerance_but_changes_the_keys(legacy):
    lost = legacy.filter("id <> 7")
    assert r.check_row_count(legacy, lost).first().passed
    assert reconcile(legacy, lost) == ["key_hash", "key_hist"]


def test_rows_lost_outside_tolerance(legacy):
    assert not r.check_row_count(legacy, legacy.filter("id >= 10")).first().passed


def test_key_replaced_with_equal_count(legacy):
    swapped = legacy.withColumn("id", F.when(F.col("id") == 5, 99999).otherwise(F.col("id")))
    assert reconcile(legacy, swapped) == ["key_hash", "key_hist"]


def test_type_changed_and_column_missing(legacy):
    retyped = legacy.withColumn("note", F.lit(1)).drop("amount").withColumn("amount", F.lit(1).cast("decimal(9,1)"))
    found = r.check_schema(legacy, retyped.drop("note")).filter("NOT passed").collect()
    assert sorted((x.column, x.new_type) for x in found) == [("amount", "decimal(9,1)"), ("note", None)]


def test_column_order_does_not_matter(legacy):
    assert r.verdict(r.check_schema(legacy, legacy.select("note", "id", "amount"))).first().passed


def test_nulls_added(legacy):
    nulled = legacy.withColumn("note", F.when(F.col("id") > 10, F.col("note")))
    row = r.check_null_rates(legacy, nulled).filter("item = 'note'").first()
    assert (row.delta, row.passed) == (0.0055, False)


def test_metric_shifted(legacy):
    assert failed(r.check_metrics(legacy, legacy.withColumn("amount", F.col("amount") * 1.01), METRICS)) == [
        "metric_avg", "metric_sum"]


def test_empty_legacy(legacy):
    nothing = legacy.filter("id < 0")
    assert reconcile(nothing, nothing) == []
    assert "row_count" in reconcile(nothing, legacy)
    assert "row_count" in reconcile(legacy, nothing)


def test_duplicate_and_null_keys_fail_first(legacy, spark):
    twice = legacy.unionByName(legacy.filter("id = 3"))
    assert {"key_unique", "key_hash"} <= set(reconcile(legacy, twice))
    missing = legacy.withColumn("id", F.when(F.col("id") > 0, F.col("id")))
    assert "key_not_null" in reconcile(legacy, missing)


def test_composite_keys_are_not_confused(spark):
    a = spark.createDataFrame([("a", "bc")], "k string, l string")
    b = spark.createDataFrame([("ab", "c")], "k string, l string")
    assert not r.check_key_hash(a, b, ["k", "l"]).first().passed


def test_histogram_covers_all_rows(legacy):
    hist = r.key_hash_histogram(legacy, legacy.filter("id <> 1"), KEY, 16)
    totals = hist.agg(F.sum("n_legacy"), F.sum("n_new"), F.count_if(~F.col("passed"))).first()
    assert tuple(totals) == (2000, 1999, 1)


def test_diff_rows(spark, rows):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3), (5, "e", 5)], "id int, s string, n int")
    new = spark.createDataFrame([(1, "a", 1), (2, "B", 2), (4, "d", 4), (5, "e", None)], "id int, s string, n int")
    assert rows(r.diff_rows(old, new, KEY)) == [
        (2, "changed", "n,s", 1, 1),
        (3, "only_legacy", "", 1, 0),
        (4, "only_new", "", 0, 1),
        (5, "changed", "n", 1, 1),
    ]


def test_diff_rows_does_not_multiply_a_hot_key(spark, rows):
    hot = spark.range(3000).select(F.lit(1).alias("id"), F.col("id").alias("v"))
    cold = spark.createDataFrame([(2, 2), (None, 3)], "id int, v bigint")
    diff = r.diff_rows(hot.unionByName(cold), hot, KEY)
    assert rows(diff) == [
        (1, "bad_key", "", 3000, 3000), (2, "only_legacy", "", 1, 0), (None, "bad_key", "", 1, 0)]


def test_diff_reports_columns(spark, rows):
    old = spark.createDataFrame([(1, "a", 1, 2.5), (2, "b", None, 1.0)], "id int, s string, n int, gone double")
    new = spark.createDataFrame([(1, "a", 1, "x"), (2, "b", 7, "y")], "id int, s string, n bigint, more string")
    assert rows(r.diff_rows(old, new, KEY)) == sorted([
        (2, "changed", "n", 1, 1), (None, "column_added", "more", 0, 0),
        (None, "column_dropped", "gone", 0, 0), (None, "column_retyped", "n", 0, 0)], key=repr)


def test_diff_with_a_retyped_key(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    new = spark.createDataFrame([("1", "a"), ("x", "b")], "id string, s string")
    assert rows(r.diff_rows(old, new, KEY)) == sorted([
        ("2", "only_legacy", "", 1, 0), ("x", "only_new", "", 0, 1), (None, "column_retyped", "id", 0, 0)], key=repr)


def test_equal_tables_move_only_digests(spark, legacy, tmp_path):
    for side in "ab":
        legacy.repartition(3).write.parquet(str(tmp_path / side))
    a, b = (spark.read.parquet(str(tmp_path / side)) for side in "ab")
    same = r.diff_rows(a, b, KEY, report_repeated=False)
    assert same.count() == 0
    assert "Exchange" not in same._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("per_bucket", [1, 64])
def test_only_rows_of_differing_buckets_are_compared(spark, rows, per_bucket, monkeypatch):
    monkeypatch.setattr(digest, "ROWS_PER_BUCKET", per_bucket)
    a = spark.range(20_000).select("id", (F.col("id") * 3).alias("v"), F.lit(None).cast("string").alias("s"))
    b = a.withColumn("v", F.when(F.col("id") == 777, -1).otherwise(F.col("v"))).filter("id <> 5")
    left, right = digest.differing_rows(a, b, KEY, ["v", "s"])
    assert left.count() <= (2 * 20 * 2 if per_bucket == 64 else 20)
    assert {r.id for r in left.collect()} >= {5, 777}
    assert rows(r.diff_rows(a, b, KEY)) == [(5, "only_legacy", "", 1, 0), (777, "changed", "v", 1, 1)]


def test_digest_tells_nulls_and_nested_values_apart(spark):
    schema = "id int, a string, b string, m map<string,int>, x array<double>"
    base = [(1, None, "q", {"k": 1}, [1.0])]
    old = spark.createDataFrame(base, schema)
    assert digest.differing_rows(old, old, KEY, ["a", "b", "m", "x"]) is None
    for other in [(1, "q", None, {"k": 1}, [1.0]), (1, None, "q", {"k": 2}, [1.0]),
                  (1, None, "q", {"k": 1}, [1.0, 2.0]), (1, None, "q", None, [1.0])]:
        new = spark.createDataFrame([other], schema)
        assert digest.differing_rows(old, new, KEY, ["a", "b", "m", "x"]) is not None


def test_distribution_is_part_of_the_verdict(legacy):
    checks = r.reconcile(legacy, legacy.filter("id <> 1"), KEY, METRICS)
    row = checks.filter("check_name = 'key_hist'").first()
    assert (row.delta, row.passed) == (1.0, False)


def test_dropped_or_text_metric_fails(legacy):
    for new in (legacy.drop("amount"), legacy.withColumn("amount", F.lit("many"))):
        checks = r.reconcile(legacy, new, KEY, METRICS)
        bad = checks.filter("check_name like 'metric%' and not passed").collect()
        assert {x.check_name for x in bad} >= {"metric_sum", "metric_avg"}
        assert not r.verdict(checks).first().passed


def days(spark, *numbers, passed=True):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=n), passed, False) for n in numbers]
    return spark.createDataFrame(rows, "day date, passed boolean, explained boolean")


@pytest.mark.parametrize(
    ("numbers", "want"),
    [(range(6), [(6, False)]), (range(7), [(7, True)]), ((0, 1, 2, 4, 5, 6, 7), [(3, False), (4, False)])],
)
def test_cutover(spark, numbers, want):
    runs = r.cutover_ready(days(spark, *numbers)).orderBy("first_day").collect()
    assert [(x.n_days, x.ready) for x in runs] == want


def test_cutover_counts_explained_days_and_spoiled_ones(spark):
    explained = days(spark, *range(7), passed=False).withColumn("explained", F.lit(True))
    assert r.cutover_ready(explained).first().ready
    spoiled = days(spark, *range(7)).unionByName(days(spark, 3, passed=False))
    assert [x.n_days for x in r.cutover_ready(spoiled).orderBy("first_day").collect()] == [3, 3]
    assert r.cutover_ready(days(spark, 0, 1, 2), min_days=3).first().ready


def test_quality(spark, rows):
    df = spark.createDataFrame([(1, None), (1, 5), (2, 50)], "k int, v int")
    assert rows(quality.check_not_null(df, ["k", "v"])) == [("k", 3, 0, True), ("v", 3, 1, False)]
    assert rows(quality.check_unique(df, ["k"])) == [(1, 2)]
    assert rows(quality.check_range(df, "v", 0, 10)) == [("v", 3, 1, False)]
