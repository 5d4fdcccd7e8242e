from __future__ import annotations

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from tablewarden.context import SyncSpec
from tablewarden.sources import listed
from tablewarden.streaming import sync

SCHEMA = "key bigint, seq bigint, op string, payload string"


def spec(tmp_path, **changes):
    fields = dict(
        source=str(tmp_path / "in"), target=str(tmp_path / "copy"), primary_key_columns=("key",),
        order_columns=("seq",), op_column="op")
    return SyncSpec(**{**fields, **changes})


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def state(df):
    return sorted((r.key, r.payload) for r in df.collect())


def brute(rows):
    newest = {}
    for key, seq, op, payload in rows:
        if key not in newest or seq > newest[key][0]:
            newest[key] = (seq, op, payload)
    return sorted((k, p) for k, (_, op, p) in newest.items() if op != "delete")


def test_duplicate_and_out_of_order_changes(spark, tmp_path):
    log = [(1, 2, "update", "new"), (1, 1, "insert", "old"), (1, 2, "update", "new"), (2, 5, "insert", "x")]
    assert state(sync.apply_changes(changes(spark, *log), spec(tmp_path))) == [(1, "new"), (2, "x")]


def test_older_insert_does_not_bring_a_deleted_row_back(spark, tmp_path):
    s = spec(tmp_path)
    schema = changes(spark).schema
    sync.write_changes(changes(spark, (1, 5, "delete", None), (2, 1, "insert", "b")), 0, s)
    sync.compact(spark, s, schema)
    sync.write_changes(changes(spark, (1, 3, "insert", "late")), 1, s)
    assert state(sync.read_copy(spark, s, schema)) == [(2, "b")]
    sync.write_changes(changes(spark, (1, 6, "insert", "again")), 2, s)
    assert state(sync.read_copy(spark, s, schema)) == [(1, "again"), (2, "b")]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    s, batch = spec(tmp_path), changes(spark, (1, 1, "insert", "a"), (2, 1, "insert", "b"))
    for _ in range(3):
        sync.write_changes(batch, 0, s, "query")
    assert state(sync.read_copy(spark, s, batch.schema)) == [(1, "a"), (2, "b")]
    assert len(list((tmp_path / "copy" / "changes").iterdir())) == 1
    sync.write_changes(batch, 0, s)  # by nobody known: kept, and seen once
    assert len(listed.live_entries(spark, s.target)) == 2
    assert state(sync.read_copy(spark, s, batch.schema)) == [(1, "a"), (2, "b")]


def test_unfinished_batch_is_not_read(spark, tmp_path):
    s, batch = spec(tmp_path), changes(spark, (1, 1, "insert", "a"))
    sync.write_changes(batch, 0, s)
    sync.write_changes(changes(spark, (1, 2, "insert", "half")), 1, s, "query")
    (tmp_path / "copy" / "commits" / "query-1.json").unlink()  # written, but died before the commit
    assert state(sync.read_copy(spark, s, batch.schema)) == [(1, "a")]


def test_empty_copy(spark, tmp_path):
    schema = changes(spark).schema
    assert sync.read_copy(spark, spec(tmp_path), schema).count() == 0
    sync.compact(spark, spec(tmp_path), schema)


def test_stream_snapshot_then_increments(spark, tmp_path):
    s = spec(tmp_path)
    rng = random.Random(5)
    log = [(rng.randrange(20), n, rng.choice(["insert", "update", "delete"]), f"p{n}") for n in range(200)]
    rng.shuffle(log)
    schema = changes(spark).schema
    done = []
    for part in (log[:80], log[80:150], log[150:]):
        changes(spark, *part).repartition(3).write.mode("append").parquet(s.source)
        done += part
        sync.sync_triggered(sync.read_changes(spark, s, schema, files_per_batch=2), s, str(tmp_path / "cp"))
        assert state(sync.read_copy(spark, s, schema)) == brute(done)
        sync.compact(spark, s, schema)
        assert state(sync.read_copy(spark, s, schema)) == brute(done)
    sync.sync_triggered(sync.read_changes(spark, s, schema), s, str(tmp_path / "cp"))
    assert state(sync.read_copy(spark, s, schema)) == brute(log)


def test_lost_checkpoint_replays_to_the_same_state(spark, tmp_path):
    s, schema = spec(tmp_path), changes(spark).schema
    changes(spark, (1, 1, "insert", "a"), (1, 2, "delete", None), (2, 1, "insert", "b")).repartition(2).write.parquet(s.source)
    for checkpoint in ("one", "two"):
        sync.sync_triggered(sync.read_changes(spark, s, schema, 1), s, str(tmp_path / checkpoint))
        assert state(sync.read_copy(spark, s, schema)) == [(2, "b")]


@pytest.mark.parametrize("compacted", [False, True])
def test_fresh_checkpoint_loses_no_later_rows(spark, tmp_path, compacted):
    """Batch numbers begin again with a new checkpoint; rows of either query count."""
    s, schema = spec(tmp_path), changes(spark).schema
    for n in range(3):
        changes(spark, (n, 1, "insert", f"a{n}")).write.mode("append").parquet(s.source)
    sync.sync_triggered(sync.read_changes(spark, s, schema, 1), s, str(tmp_path / "one"))
    if compacted:
        assert sync.compact(spark, s, schema)
    changes(spark, (1, 2, "delete", None), (7, 1, "insert", "b7")).write.mode("append").parquet(s.source)
    sync.sync_triggered(sync.read_changes(spark, s, schema), s, str(tmp_path / "two"))
    assert state(sync.read_copy(spark, s, schema)) == [(0, "a0"), (2, "a2"), (7, "b7")]


def test_same_checkpoint_commits_a_batch_once(spark, tmp_path):
    s, schema = spec(tmp_path), changes(spark).schema
    changes(spark, (1, 1, "insert", "a")).write.parquet(s.source)
    sync.sync_triggered(sync.read_changes(spark, s, schema), s, str(tmp_path / "cp"))
    [entry] = listed.live_entries(spark, s.target)
    # The batch is written and listed, but the query dies before it notes that in its checkpoint.
    (tmp_path / "cp" / "commits" / "0").unlink()
    (tmp_path / "cp" / "commits" / ".0.crc").unlink(missing_ok=True)
    sync.sync_triggered(sync.read_changes(spark, s, schema), s, str(tmp_path / "cp"))
    assert listed.live_entries(spark, s.target) == [entry]
    assert len(list((tmp_path / "copy" / "changes").iterdir())) == 1


def test_success_markers_do_not_matter(spark, tmp_path):
    s, schema = spec(tmp_path), changes(spark).schema
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        sync.write_changes(changes(spark, (1, 1, "insert", "a"), (2, 1, "insert", "b")), 0, s)
        sync.compact(spark, s, schema)
        sync.write_changes(changes(spark, (2, 2, "delete", None)), 1, s)
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert not list((tmp_path / "copy").rglob("_SUCCESS"))
    assert state(sync.read_copy(spark, s, schema)) == [(1, "a")]


def test_batch_committed_during_compaction_stays(spark, tmp_path, monkeypatch):
    s, schema = spec(tmp_path), changes(spark).schema
    sync.write_changes(changes(spark, (1, 1, "insert", "a")), 0, s)
    commit = listed.commit

    def late(session, root, entry):
        monkeypatch.setattr(listed, "commit", commit)
        sync.write_changes(changes(spark, (2, 1, "insert", "b")), 1, s)
        commit(session, root, entry)

    monkeypatch.setattr(listed, "commit", late)
    sync.compact(spark, s, schema)
    assert state(sync.read_copy(spark, s, schema)) == [(1, "a"), (2, "b")]


def test_two_compactions_at_once(spark, tmp_path, monkeypatch):
    s, schema = spec(tmp_path), changes(spark).schema
    sync.write_changes(changes(spark, (1, 1, "insert", "a"), (2, 1, "insert", "b")), 0, s)
    sync.write_changes(changes(spark, (1, 2, "update", "c")), 1, s)
    before = listed.all_entries(spark, s.target)
    sync.compact(spark, s, schema)
    monkeypatch.setattr(listed, "all_entries", lambda *_: before)
    sync.compact(spark, s, schema)
    monkeypatch.undo()
    assert sum(e.snapshot for e in listed.live_entries(spark, s.target)) == 2
    sync.write_changes(changes(spark, (2, 2, "delete", None)), 2, s)
    assert state(sync.read_copy(spark, s, schema)) == [(1, "c")]
    sync.compact(spark, s, schema)
    assert len(listed.live_entries(spark, s.target)) == 1
    assert state(sync.read_copy(spark, s, schema)) == [(1, "c")]


def test_superseded_parts_go(spark, tmp_path):
    s, schema = spec(tmp_path), changes(spark).schema
    for n in range(3):
        sync.write_changes(changes(spark, (n, 1, "insert", f"p{n}")), n, s)
    sync.compact(spark, s, schema)
    sync.write_changes(changes(spark, (5, 1, "insert", "p5")), 3, s)
    assert listed.drop_superseded(spark, s.target, keep_seconds=3_600) == 0
    assert listed.drop_superseded(spark, s.target, keep_seconds=0) == 3
    assert len(list((tmp_path / "copy" / "changes").iterdir())) == 1
    (tmp_path / "copy" / "changes" / "died-1").mkdir()
    assert listed.drop_unlisted(spark, s.target, (sync.CHANGES, sync.SNAPSHOTS), 3_600) == 0
    assert listed.drop_unlisted(spark, s.target, (sync.CHANGES, sync.SNAPSHOTS), 0) == 1
    assert state(sync.read_copy(spark, s, schema)) == [(0, "p0"), (1, "p1"), (2, "p2"), (5, "p5")]


def test_continuous_copy_stays_readable_and_tells_of_lag(spark, tmp_path):
    """Many batches, few folders; an alert from the running query."""
    s, schema = spec(tmp_path, scheduling_policy="CONTINUOUS"), changes(spark).schema
    for n in range(10):
        changes(spark, (n, 1, "insert", f"p{n}")).coalesce(1).write.mode("append").parquet(s.source)
    late = []
    stream = sync.read_changes(spark, s, schema, 1, arrived="_arrived")
    query = sync.sync_continuous(
        stream, s, str(tmp_path / "cp"), "0 seconds", compact_after=3, arrived="_arrived",
        on_lag=lambda *what: late.append(what), max_lag=0.0)
    most = 0
    try:
        while query.lastProgress is None or query.lastProgress.batchId < 9:
            most = max(most, len(listed.live_entries(spark, s.target)))
            query.processAllAvailable()
    finally:
        query.stop()
    assert most <= 4 and len(listed.live_entries(spark, s.target)) <= 4
    assert state(sync.read_copy(spark, s, schema)) == [(n, f"p{n}") for n in range(10)]
    for _ in range(50):
        if len(late) >= 10:
            break
        time.sleep(0.2)
    assert {batch for _, batch, _ in late} == set(range(10))
    assert all(lag > 0 for *_, lag in late)


def test_continuous(spark, tmp_path):
    s, schema = spec(tmp_path, scheduling_policy="CONTINUOUS"), changes(spark).schema
    changes(spark, (1, 1, "insert", "a")).write.parquet(s.source)
    query = sync.sync_continuous(sync.read_changes(spark, s, schema), s, str(tmp_path / "cp"), "1 second")
    try:
        query.processAllAvailable()
        changes(spark, (1, 2, "update", "b")).write.mode("append").parquet(s.source)
        query.processAllAvailable()
    finally:
        query.stop()
    assert state(sync.read_copy(spark, s, schema)) == [(1, "b")]


def test_without_deletes(spark, tmp_path):
    s = spec(tmp_path, op_column=None)
    sync.write_changes(changes(spark, (1, 1, "delete", "kept")), 0, s)
    assert state(sync.read_copy(spark, s, changes(spark).schema)) == [(1, "kept")]


def test_deletes_follow_the_source(spark, rows):
    copy = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "v string, k int")
    source = spark.createDataFrame([(2,), (2,)], "k int")
    assert rows(sync.propagate_deletes(copy, source, ["k"])) == [("b", 2)]


@pytest.mark.parametrize(
    ("policy", "seconds", "alert"),
    [("TRIGGERED", 240, False), ("TRIGGERED", 300, False), ("TRIGGERED", 360, True),
     ("CONTINUOUS", 29, False), ("CONTINUOUS", 31, True), ("CONTINUOUS", -5, False)],
)
def test_lag(spark, policy, seconds, alert):
    now = dt.datetime(2024, 1, 1, 12)
    source = spark.createDataFrame([(now,), (now - dt.timedelta(hours=1),)], "ts timestamp")
    copy = spark.createDataFrame([(now - dt.timedelta(seconds=seconds),)], "ts timestamp")
    row = sync.sync_lag(source, copy, "ts", "ts", policy).first()
    assert (row.lag_seconds, row.alert) == (max(seconds, 0), alert)


def test_lag_of_empty_sides(spark):
    some = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "ts timestamp")
    none = some.filter("false")
    assert sync.sync_lag(some, none, "ts", "ts", "TRIGGERED").first().alert
    assert not sync.sync_lag(none, none, "ts", "ts", "TRIGGERED").first().alert


def test_merge_policies(spark, rows):
    a = spark.createDataFrame([(1, 10, "a1"), (2, 10, "a2"), (3, 10, "a3")], "k int, ts int, v string")
    b = spark.createDataFrame([(2, 20, "b2"), (3, 10, "b3"), (4, 1, "b4")], "k int, ts int, v string")

    def merged(policy):
        return rows(sync.merge_bidirectional(a, b, ["k"], "ts", policy).select("k", "v"))

    assert merged("last_writer") == [(1, "a1"), (2, "b2"), (3, "a3"), (4, "b4")]
    assert merged("source_wins") == [(1, "a1"), (2, "a2"), (3, "a3"), (4, "b4")]
    assert merged("target_wins") == [(1, "a1"), (2, "b2"), (3, "b3"), (4, "b4")]
    with pytest.raises(ValueError):
        merged("random")


def test_ingest_drops_repeats_across_files(spark, tmp_path):
    now = dt.datetime(2024, 1, 1)
    rows = [(i % 5, now + dt.timedelta(minutes=i)) for i in range(20)]
    df = spark.createDataFrame(rows, "event_id int, ts timestamp_ntz")
    for part in range(3):
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = sync.ingest_stream(spark, str(tmp_path / "in"), df.schema, files_per_batch=1)
    (stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
     .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination())
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("horizon", [None, dt.timedelta(hours=1)])
def test_ingest_keeps_late_rows_in_any_slicing(spark, tmp_path, horizon):
    """The backlog in one batch, in batches in order, and newest first."""
    start, schema = dt.datetime(2024, 1, 1), "event_id int, ts timestamp, body string"
    days = [[(d * 10 + i % 6, start + dt.timedelta(days=d, minutes=i % 6), "x") for i in range(9)] for d in range(3)]
    days[1].append((None, start, "no id"))
    days[2].append((None, start, "no id"))
    want = sorted({r[0] for day in days for r in day}, key=repr)
    slicings = {"one": [sum(days, [])], "twice": days[::-1] + days[1:]}
    for name, batches in slicings.items():
        target, source = str(tmp_path / name), str(tmp_path / f"{name}-in")
        for rows_ in batches:
            spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        sync.ingest(stream, target, str(tmp_path / f"{name}-cp"), horizon=horizon, fold_after=3)
        got = sync.read_ingested(spark, target, stream.schema)
        assert sorted((r.event_id for r in got.collect()), key=repr) == want
        assert len(listed.live_entries(spark, target)) <= 4
        # Again with a fresh checkpoint: nothing new.
        sync.ingest(stream, target, str(tmp_path / f"{name}-cp2"), horizon=horizon)
        assert sync.read_ingested(spark, target, stream.schema).count() == len(want)


@pytest.mark.parametrize("small", [True, False])
def test_ingest_writes_and_reads_by_many_tasks(spark, tmp_path, monkeypatch, small):
    """Three batches of as many files as there are tasks; null ids are equal, large batches as well."""
    from tablewarden.plans import copies

    rows = [(i, None if i % 7 == 0 else i % 50, "ab"[i % 2], float(i % 3), f"2024-01-{1 + i % 28:02d} 00:00:00")
            for i in range(400)]
    events = spark.createDataFrame(rows, "event_id long, user_id int, event_type string, value double, ts string")
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(copies, "shared_dir", lambda spark: str(tmp_path / "run"))
    monkeypatch.setattr(sync, "is_small", lambda df: small)
    got = sorted(map(tuple, copies.ingest_dedup(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted({(u, e, v) for _, u, e, v, _ in rows}, key=str)
    assert len(list((tmp_path / "run/in").glob("*.parquet"))) > 3
    assert len(list((tmp_path / "run/checkpoint/commits").glob("[0-9]*"))) == 3
