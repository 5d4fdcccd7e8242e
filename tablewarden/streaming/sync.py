"""Keyed copies kept up to date by Structured Streaming.

Parquet has no MERGE, and rewriting a large target for every batch would not
scale. A target is therefore a listed table of net changes: each micro-batch writes
its newest row per key as one part and then puts a line for it in the list
(`sources.listed`), named by the query's id and the batch. A replayed batch finds its
line and does nothing; a query with a fresh checkpoint has another id, so its batches
are never taken for those of an earlier one. Readers take the newest row per key over
all parts; deletes stay as tombstones, so an older insert that arrives late cannot bring
a row back, and a change that is there twice counts once. `compact` folds parts into a
snapshot: a new part that replaces the lines it has read, and no others.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tablewarden.context import (
    SyncSpec, cut_lineage, is_small, lookup_join, shared_dir, small_or_shuffled,
)
from tablewarden.operators.ordered import latest_by_key
from tablewarden.sources import listed
from tablewarden.sources.listed import Entry

# How far a copy may fall behind, in seconds.
MAX_LAG_SECONDS = {"TRIGGERED": 300, "CONTINUOUS": 30}

CHANGES, SNAPSHOTS = "changes", "snapshots"
#: A standing query folds its parts when there are so many, so that a read opens few folders.
COMPACT_AFTER = 20


def write_changes(batch: DataFrame, batch_id: int, spec: SyncSpec, run: str | None = None) -> None:
    """The sink of every sync: the batch's newest row per key, as a part of its own.

    `run` names the query that counts the batches; without it the batch is new in any case.
    """
    spark = batch.sparkSession
    name = f"{run or uuid.uuid4()}-{batch_id}"
    if listed.is_committed(spark, spec.target, name):
        return
    part = listed.new_part(CHANGES, name)
    newest = latest_by_key(batch, list(spec.primary_key_columns), list(spec.order_columns))
    newest.write.parquet(f"{spec.target}/{part}")
    listed.commit(spark, spec.target, Entry(name, (part,)))


def _newest(
    spark: SparkSession, spec: SyncSpec, schema: T.StructType, entries: list[Entry]
) -> DataFrame:
    """The newest row per key over some parts, deleted keys included.

    Only snapshot rows whose key has changed since are compared with the
    changes. The keys that changed are counted first; a moderate number is
    broadcast, so that the snapshot itself is filtered where it is read. Of two
    snapshots, made at the same time, the older is read like changes.
    """
    keys, order = list(spec.primary_key_columns), list(spec.order_columns)
    base = [e for e in entries if e.snapshot][-1:]
    later = listed.paths_of(spec.target, [e for e in entries if e not in base])
    reader = spark.read.schema(schema)
    changes = latest_by_key(reader.parquet(*later), keys, order) if later else None
    unchanged = listed.paths_of(spec.target, base)
    if not unchanged:
        return spark.createDataFrame([], schema) if changes is None else changes
    snapshot = reader.parquet(*unchanged)
    if changes is None:
        return snapshot
    changed = small_or_shuffled(cut_lineage(changes.select(*keys)))
    columns = snapshot.columns
    touched = snapshot.join(changed, keys, "left_semi").select(*columns)
    untouched = snapshot.join(changed, keys, "left_anti").select(*columns)
    return untouched.unionByName(latest_by_key(touched.unionByName(changes), keys, order))


def read_copy(spark: SparkSession, spec: SyncSpec, schema: T.StructType) -> DataFrame:
    """The current rows of the copy, deleted keys left out."""
    rows = _newest(spark, spec, schema, listed.live_entries(spark, spec.target))
    if spec.op_column is None:
        return rows
    return rows.filter(~F.col(spec.op_column).eqNullSafe(F.lit(spec.delete_value)))


def compact(spark: SparkSession, spec: SyncSpec, schema: T.StructType, at_least: int = 1) -> bool:
    """Fold all parts into a new snapshot if there are `at_least` so many of changes.

    Tombstones are kept. A batch that is committed meanwhile is not folded, and stays.
    """
    before = listed.all_entries(spark, spec.target)
    folded = {name for e in before for name in e.folds}
    live = [e for e in before if e.name not in folded]
    if sum(not e.snapshot for e in live) < at_least:
        return False
    part = listed.new_part(SNAPSHOTS)
    _newest(spark, spec, schema, live).write.parquet(f"{spec.target}/{part}")
    listed.commit(spark, spec.target, Entry(
        f"snapshot-{uuid.uuid4()}", (part,), True, tuple(e.name for e in before)))
    return True


def _query_id(batch: DataFrame) -> str | None:
    """The id that a query keeps in its checkpoint over restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def _start(stream: DataFrame, spec: SyncSpec, checkpoint: str, compact_after: int | None, **trigger):
    schema = stream.schema

    def apply(batch: DataFrame, batch_id: int) -> None:
        write_changes(batch, batch_id, spec, _query_id(batch))
        if compact_after is not None:
            compact(batch.sparkSession, spec, schema, compact_after)

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_changes(
    spark: SparkSession,
    spec: SyncSpec,
    schema: T.StructType,
    files_per_batch: int | None = None,
    arrived: str | None = None,
) -> DataFrame:
    """The change log as a stream; `arrived` adds when a row's file came, for the lag alert."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    log = reader.parquet(spec.source)
    if arrived:
        log = log.select(*schema.names, F.col("_metadata.file_modification_time").alias(arrived))
    return log


def sync_triggered(stream: DataFrame, spec: SyncSpec, checkpoint: str) -> None:
    """Bring the copy up to date and stop: the first run takes everything, later runs what is new."""
    _start(stream, spec, checkpoint, None, availableNow=True).awaitTermination()


class LagAlert(StreamingQueryListener):
    """Calls `alert(query_id, batch_id, lag_seconds)` when a batch was readable too late.

    The lag of a batch is the time from the arrival of its first row to its commit. It is
    taken from figures that Spark reports while the query runs; nothing is read for it.
    """

    def __init__(self, name: str, limit_seconds: float, alert: Callable[[str, int, float], None]):
        self.name, self.limit, self.alert = name, limit_seconds, alert

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        seen = (progress.observedMetrics or {}).get(self.name)
        first = seen["first"] if seen is not None else None
        if first is None:
            return
        begun = dt.datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00")).timestamp()
        lag = begun + progress.batchDuration / 1000 - first
        if lag > self.limit:
            self.alert(str(progress.id), progress.batchId, lag)


def sync_continuous(
    stream: DataFrame,
    spec: SyncSpec,
    checkpoint: str,
    every: str = "10 seconds",
    compact_after: int = COMPACT_AFTER,
    arrived: str | None = None,
    on_lag: Callable[[str, int, float], None] | None = None,
    max_lag: float = MAX_LAG_SECONDS["CONTINUOUS"],
) -> StreamingQuery:
    """Keep the copy up to date, and readable, until the returned query is stopped.

    Parts are folded when there are `compact_after` of them. With `arrived`, the column of
    `read_changes`, `on_lag` is called for a batch that comes later than `max_lag` seconds.
    """
    if arrived is not None:
        name = f"sync-{uuid.uuid4()}"
        stream = stream.observe(name, F.min(F.col(arrived).cast("double")).alias("first")).drop(arrived)
        if on_lag is not None:
            stream.sparkSession.streams.addListener(LagAlert(name, max_lag, on_lag))
    return _start(stream, spec, checkpoint, compact_after, processingTime=every)


def apply_changes(changes: DataFrame, spec: SyncSpec) -> DataFrame:
    """The state a change log leads to, in batch: newest change per key, deletes applied."""
    newest = latest_by_key(changes, list(spec.primary_key_columns), list(spec.order_columns))
    if spec.op_column is None:
        return newest
    return newest.filter(~F.col(spec.op_column).eqNullSafe(F.lit(spec.delete_value)))


def propagate_deletes(copy: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The copy without rows whose key the source no longer has."""
    return lookup_join(copy, source.select(*keys).distinct(), keys, "left_semi")


def sync_lag(
    source: DataFrame, copy: DataFrame, source_ts: str, copy_ts: str, policy: str
) -> DataFrame:
    """Seconds the copy trails its source, and whether that is too much for the policy.

    An empty source cannot be behind; an empty copy of a filled source always is.
    """
    tagged = source.select(F.col(source_ts).alias("s"), F.lit(None).alias("c")).unionByName(
        copy.select(F.lit(None).alias("s"), F.col(copy_ts).alias("c"))
    )
    newest = tagged.agg(F.max("s").alias("source_ts"), F.max("c").alias("copy_ts"))
    lag: Column = F.timestamp_diff("MICROSECOND", F.col("copy_ts"), F.col("source_ts"))
    behind = F.coalesce(F.greatest(lag, F.lit(0)), F.lit(0)).cast("bigint")
    return newest.select(
        "source_ts",
        "copy_ts",
        F.floor(behind / 1_000_000).alias("lag_seconds"),
        (
            (behind > MAX_LAG_SECONDS[policy] * 1_000_000)
            | (F.isnull("copy_ts") & F.isnotnull("source_ts"))
        ).alias("alert"),
    )


def ingest_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    ts: str = "ts",
    ids: tuple[str, ...] = ("event_id",),
    delay: str = "1 hour",
    files_per_batch: int | None = None,
) -> DataFrame:
    """A file stream with repeated ids dropped; state is kept only for the watermark delay.

    Rows later than the watermark are dropped with it; `ingest` keeps them.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.parquet(path)
        .withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, delay)
        .dropDuplicatesWithinWatermark(list(ids))
    )


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & left[c].eqNullSafe(right[c])
    return same


def _unseen(
    batch: DataFrame, target: str, ids: list[str], ts: str, horizon: dt.timedelta | None
) -> DataFrame:
    """The rows of a materialised batch, one for each id, whose id the table does not have."""
    spark = batch.sparkSession
    fresh = batch.dropDuplicates(ids)
    parts = listed.paths_of(target, listed.live_entries(spark, target))
    if not parts:
        return fresh
    known = spark.read.schema(batch.schema).parquet(*parts)
    first, last = batch.agg(F.min(ts), F.max(ts)).first()
    if horizon is not None and first is not None:
        # Reaches the scan: files and row groups far from the batch are not opened.
        near = F.col(ts).between(F.lit(first - horizon), F.lit(last + horizon))
        known = known.filter(near | F.isnull(ts))
    asked = batch.select(*ids).distinct()
    # The table is read by its id columns alone. By a small batch it is filtered where it is
    # read; beside a large one it is moved once.
    seen = known.select(*ids)
    if is_small(asked):
        asked = F.broadcast(asked)
        seen = seen.join(asked, _same(seen, asked, ids), "left_semi").distinct()
    return fresh.join(seen, _same(fresh, seen, ids), "left_anti")


def ingest(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    ids: tuple[str, ...] = ("event_id",),
    ts: str = "ts",
    horizon: dt.timedelta | None = None,
    fold_after: int = COMPACT_AFTER,
) -> None:
    """Bring the listed table at `target` up to date with a stream, each id once, and stop.

    No row is too late: a batch is compared with the table itself, not with state that a
    watermark clears, so a backlog gives the same rows however it is cut into batches.
    Rows that share their ids must be alike (a message delivered again). With `horizon`,
    event times of repeats are at most so far apart, and only that part of the table is
    looked at. Null ids are equal to each other.
    """
    schema = stream.schema

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"{_query_id(batch) or uuid.uuid4()}-{batch_id}"
        if listed.is_committed(spark, target, name):
            return
        scratch = shared_dir(spark)
        try:
            batch.write.parquet(scratch)
            rows = _unseen(spark.read.schema(schema).parquet(scratch), target, list(ids), ts, horizon)
            part = listed.new_part(CHANGES, name)
            rows.write.parquet(f"{target}/{part}")
            listed.commit(spark, target, Entry(name, (part,)))
        finally:
            listed.delete(spark, scratch)
        small = [e for e in listed.live_entries(spark, target) if not e.snapshot]
        if len(small) >= fold_after:
            # Small parts become one; what is folded once is not written again.
            part = listed.new_part(SNAPSHOTS)
            spark.read.schema(schema).parquet(*listed.paths_of(target, small)).coalesce(
                max(1, len(small) // 4)).write.parquet(f"{target}/{part}")
            listed.commit(spark, target, Entry(
                f"folded-{uuid.uuid4()}", (part,), True, tuple(e.name for e in small)))

    stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()


def read_ingested(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    parts = listed.paths_of(target, listed.live_entries(spark, target))
    return spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)


def merge_bidirectional(
    a: DataFrame, b: DataFrame, keys: list[str], ts: str, policy: str = "last_writer"
) -> DataFrame:
    """One row per key out of two sides that were both written to.

    `last_writer` takes the later `ts`, `a` when equal; `source_wins` takes `a`
    where it has the key, `target_wins` takes `b`. Adds `side`.
    """
    if policy not in ("last_writer", "source_wins", "target_wins"):
        raise ValueError(f"unknown policy {policy!r}")
    if set(a.columns) != set(b.columns):
        raise ValueError("both sides need the same columns")
    both = a.withColumn("side", F.lit("source")).unionByName(
        b.withColumn("side", F.lit("target"))
    )
    favoured = "target" if policy == "target_wins" else "source"
    both = both.withColumn("_favoured", (F.col("side") == favoured).cast("int"))
    order = [ts, "_favoured"] if policy == "last_writer" else ["_favoured", ts]
    return latest_by_key(both, keys, order).drop("_favoured")
