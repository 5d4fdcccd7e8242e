"""Keyed copies: events as a change log, one row per user, `error` as the delete."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.context import SyncSpec, shared_dir
from tablewarden.operators.ordered import latest_by_key
from tablewarden.plans.derived import table
from tablewarden.streaming import sync


def spec_for(spark, d, target: str) -> SyncSpec:
    # A glob, because a file stream wants a folder or a pattern.
    return SyncSpec(
        source=f"{d}/events*.parquet",
        target=target,
        primary_key_columns=("user_id",),
        order_columns=("ts", "event_id"),
        op_column="event_type",
        delete_value="error",
    )


def _shown(df):
    return df.select("user_id", "event_id", "event_type", "value")


def latest(spark, d):
    return _shown(latest_by_key(table(spark, d, "events"), ["user_id"], ["ts", "event_id"]))


def apply_changes(spark, d):
    return _shown(sync.apply_changes(table(spark, d, "events"), spec_for(spark, d, "")))


def sync_triggered(spark, d):
    """Drained twice: the second run finds nothing new and leaves the copy as it is."""
    root = shared_dir(spark)
    spec = spec_for(spark, d, f"{root}/copy")
    schema = table(spark, d, "events").schema
    for _ in range(2):
        stream = sync.read_changes(spark, spec, schema)
        sync.sync_triggered(stream, spec, f"{root}/checkpoint")
    return _shown(sync.read_copy(spark, spec, schema))


def sync_compacted(spark, d):
    """The same copy folded into a snapshot, then a whole batch replayed over it."""
    root = shared_dir(spark)
    spec = spec_for(spark, d, f"{root}/copy")
    events = table(spark, d, "events")
    early = events.filter("value < 50")
    sync.write_changes(early, 0, spec)
    sync.write_changes(events, 1, spec)
    sync.compact(spark, spec, events.schema)
    sync.write_changes(early, 2, spec)
    return _shown(sync.read_copy(spark, spec, events.schema))


def sync_retriggered(spark, d):
    """A compacted copy whose checkpoint is lost: the sync runs again from the beginning."""
    root = shared_dir(spark)
    spec = spec_for(spark, d, f"{root}/copy")
    events = table(spark, d, "events")
    sync.write_changes(events.filter("value < 50"), 0, spec, "first query")
    sync.compact(spark, spec, events.schema)
    for n in range(2):
        stream = sync.read_changes(spark, spec, events.schema)
        sync.sync_triggered(stream, spec, f"{root}/checkpoint-{n}")
    return _shown(sync.read_copy(spark, spec, events.schema))


def sync_continuous(spark, d):
    """A standing query, stopped once it has caught up."""
    root = shared_dir(spark)
    spec = spec_for(spark, d, f"{root}/copy")
    schema = table(spark, d, "events").schema
    query = sync.sync_continuous(
        sync.read_changes(spark, spec, schema, arrived="_arrived"), spec, f"{root}/checkpoint",
        "1 second", compact_after=1, arrived="_arrived",
    )
    query.processAllAvailable()
    query.stop()
    return _shown(sync.read_copy(spark, spec, schema))


def ingest_dedup(spark, d):
    """Events to a bronze table in three batches: the newer half, then older ones, late by any
    watermark, then everything once more. Event type, user and value together are the id."""
    root = shared_dir(spark)
    events = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    middle = events.agg(F.expr("percentile_approx(ts, 0.5)")).first()[0]
    for part in (events.filter(F.col("ts") >= middle), events.filter(F.col("ts") < middle), events):
        part.write.mode("append").parquet(f"{root}/in")
        # What has come since the last run is one batch, however many files it has.
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        sync.ingest(stream, f"{root}/bronze", f"{root}/checkpoint", ("user_id", "event_type", "value"),
                    fold_after=3)
    bronze = sync.read_ingested(spark, f"{root}/bronze", events.schema)
    return bronze.select("user_id", "event_type", "value")


def delete_propagation(spark, d):
    """Orders copied earlier lose the customers that the source has dropped."""
    kept = table(spark, d, "customer").filter("c_acctbal >= 0")
    copy = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return sync.propagate_deletes(copy, kept, ["c_custkey"])


def sync_lag(spark, d):
    events = table(spark, d, "events")
    copy = events.filter("event_type <> 'error' AND value < 400")
    return (
        sync.sync_lag(events, copy, "ts", "ts", "TRIGGERED")
        .withColumn("policy", F.lit("TRIGGERED"))
        .unionByName(
            sync.sync_lag(events, copy, "ts", "ts", "CONTINUOUS").withColumn(
                "policy", F.lit("CONTINUOUS")
            )
        )
    )


def _two_sides(spark, d):
    events = table(spark, d, "events").select("user_id", "event_id", "ts", "value")
    left = latest_by_key(events.filter("value < 80"), ["user_id"], ["ts", "event_id"])
    right = latest_by_key(events.filter("value >= 30"), ["user_id"], ["ts", "event_id"])
    return left, right


def merge(policy: str):
    def run(spark, d):
        merged = sync.merge_bidirectional(*_two_sides(spark, d), ["user_id"], "ts", policy)
        return merged.select("user_id", "event_id", "side")

    return run


QUERIES = {
    "latest_by_key": latest,
    "apply_changes": apply_changes,
    "sync_triggered": sync_triggered,
    "sync_compacted": sync_compacted,
    "sync_retriggered": sync_retriggered,
    "sync_continuous": sync_continuous,
    "ingest_dedup": ingest_dedup,
    "delete_propagation": delete_propagation,
    "sync_lag": sync_lag,
    "merge_last_writer": merge("last_writer"),
    "merge_source_wins": merge("source_wins"),
    "merge_target_wins": merge("target_wins"),
}

_NEWEST = """newest AS (
    SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id)"""
_STATE = f"""WITH {_NEWEST}
    SELECT e.user_id, e.event_id, e.event_type, e.value
    FROM newest n JOIN events e ON e.event_id = n.event_id"""
_LIVE = _STATE + " WHERE e.event_type <> 'error'"
_SIDES = """WITH a AS (
        SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, MAX(ts) AS ts
        FROM events WHERE value < 80 GROUP BY user_id),
    b AS (
        SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, MAX(ts) AS ts
        FROM events WHERE value >= 30 GROUP BY user_id),
    paired AS (
        SELECT COALESCE(a.user_id, b.user_id) AS user_id, a.event_id AS ea, b.event_id AS eb,
               a.ts AS ta, b.ts AS tb FROM a FULL JOIN b ON a.user_id = b.user_id)"""


def _merged(take_a: str) -> str:
    return f"""{_SIDES}
        SELECT user_id, CASE WHEN {take_a} THEN ea ELSE eb END AS event_id,
               CASE WHEN {take_a} THEN 'source' ELSE 'target' END AS side FROM paired"""


SQL = {
    "latest_by_key": _STATE,
    "apply_changes": _LIVE,
    "sync_triggered": _LIVE,
    "sync_compacted": _LIVE,
    "sync_retriggered": _LIVE,
    "sync_continuous": _LIVE,
    "ingest_dedup": "SELECT DISTINCT user_id, event_type, value FROM events",
    "delete_propagation": """SELECT o_orderkey, o_custkey AS c_custkey FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
    "sync_lag": """WITH newest AS (
            SELECT MAX(ts) AS source_ts,
                   MAX(ts) FILTER (WHERE event_type <> 'error' AND value < 400) AS copy_ts
            FROM events),
        lag AS (SELECT *, CAST(floor(epoch(source_ts - copy_ts)) AS BIGINT) AS lag_seconds
                FROM newest)
        SELECT source_ts, copy_ts, lag_seconds, epoch(source_ts - copy_ts) > 300 AS alert, 'TRIGGERED' AS policy
        FROM lag
        UNION ALL SELECT source_ts, copy_ts, lag_seconds, epoch(source_ts - copy_ts) > 30, 'CONTINUOUS' FROM lag""",
    "merge_last_writer": _merged("eb IS NULL OR ta >= tb"),
    "merge_source_wins": _merged("ea IS NOT NULL"),
    "merge_target_wins": _merged("eb IS NULL"),
}
