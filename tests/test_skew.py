"""One key with a large share of the rows: same results, and plans that split it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablewarden import context
from tablewarden.operators import audit

SMALL_PIECES = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture
def small_pieces(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL_PIECES}
    for k, v in SMALL_PIECES.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def uneven(spark):
    """60,000 rows, a third of them with key 7."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000)
    rows = spark.range(0, 60_000, 1, 12).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    return rows


def test_small_lookup_is_broadcast_and_rows_stay(uneven):
    lookup = uneven.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    plan = context.lookup_join(uneven, lookup, ["k"], "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_large_lookup_splits_the_hot_key(uneven, small_pieces, how):
    lookup = uneven.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = context.lookup_join(uneven, lookup, ["k"], how, max_rows=0)
    n = joined.count()
    assert n == (0 if how == "left_anti" else 60_000)
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [5_000, 1_000_000])
def test_timeline_of_one_hot_bundle(spark, limit):
    log = spark.range(0, 30_000, 1, 6).select(
        "id", F.timestamp_seconds(F.col("id") / 100).alias("ts"),
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("b"), F.col("id") % 50)).alias("bundle"),
        F.lit("prod").alias("target"), F.concat(F.lit("s"), F.col("id") * 31 % 97 % 11).alias("git_sha"),
    )
    got = audit.deploy_timeline(log, sequence="id", max_rows=limit)
    want, last, seen = {}, {}, set()
    for r in sorted(log.collect(), key=lambda r: (r.ts, r.id)):
        before = last.get(r.bundle)
        want[r.id] = (before, before not in (None, r.git_sha) and (r.bundle, r.git_sha) in seen)
        last[r.bundle] = r.git_sha
        seen.add((r.bundle, r.git_sha))
    assert {r.id: (r.previous_sha, r.is_rollback) for r in got.collect()} == want
