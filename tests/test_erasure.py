from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablewarden.context import SyncSpec
from tablewarden.operators import erasure
from tablewarden.operators.erasure import Stored
from tablewarden.operators.privacy import SubjectLink
from tablewarden.sources import listed
from tablewarden.streaming import sync

LINK = {"people": SubjectLink("who")}


@pytest.fixture
def tickets(spark):
    return spark.createDataFrame(
        [("T1", 3), ("T2", 99), ("T3", None), ("", 4), (None, 5)], "ticket string, subject_id bigint")


def stored(spark, tmp_path, by=()):
    df = spark.range(40).select(F.col("id").alias("n"), (F.col("id") % 8).alias("who"),
                                (F.col("id") % 3).cast("int").alias("place"))
    path = str(tmp_path / "people")
    # Sorted by subject, so that most files hold none of the erased ones.
    writer = df.repartitionByRange(4, "who").write
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return Stored(path, spark.read.parquet(path).schema, by)


def holders(spark, tmp_path, table):
    """Data files anywhere below the folder, read one by one, that hold subject 3."""
    files = [p for p in (tmp_path / table).rglob("*") if p.is_file() and p.suffix == ".parquet"]
    assert files
    return [p for p in files if spark.read.parquet(str(p)).filter("who = 3").count()]


@pytest.mark.parametrize("by", [(), ("place",)])
@pytest.mark.parametrize("at_once", [1, 1_000])
def test_only_files_with_the_subject_are_rewritten(spark, tmp_path, tickets, rows, by, at_once):
    table = stored(spark, tmp_path, by)
    before = {p for p in (tmp_path / "people").rglob("part-*.parquet")}
    touched = set(holders(spark, tmp_path, "people"))
    erasure.erase_stored(spark, {"people": table}, tickets, LINK, str(tmp_path / "audit"), files_at_once=at_once)
    after = {p for p in (tmp_path / "people").rglob("part-*.parquet")}
    assert before - after == touched and len(touched) < len(before)
    assert holders(spark, tmp_path, "people") == []
    assert not (tmp_path / "people" / "_erase").exists()
    want = [(n, n % 8, n % 3) for n in range(40) if n % 8 != 3]
    assert rows(spark.read.parquet(table.path).select("n", "who", "place")) == sorted(want, key=repr)


def test_audit_is_appended_with_time_and_without_subject(spark, tmp_path, tickets, rows):
    table, path = {"people": stored(spark, tmp_path)}, str(tmp_path / "audit")
    for day in ("2024-01-01 10:00:00", "2024-01-02 10:00:00"):
        erasure.erase_stored(spark, table, tickets, LINK, path, F.lit(day))
    got = [(r.ticket, r.subject_id, r.rows_removed, str(r.ts)) for r in erasure.read_erasures(spark, path).collect()]
    first, second = "2024-01-01 10:00:00", "2024-01-02 10:00:00"
    assert sorted(got, key=repr) == sorted([
        ("T1", "3", 5, first), ("T2", "99", 0, first), ("T3", None, 0, first),
        ("T1", "3", 0, second), ("T2", "99", 0, second), ("T3", None, 0, second)], key=repr)
    assert sorted(p.name for p in (tmp_path / "audit").glob("date=*")) == ["date=2024-01-01", "date=2024-01-02"]


@pytest.mark.parametrize("step", ["journal", "moves", "removals"])
def test_interrupted_erasure_is_finished_by_the_next(spark, tmp_path, tickets, rows, step, monkeypatch):
    table = stored(spark, tmp_path)

    def die(*_):
        raise RuntimeError("lost")

    delete = listed.delete
    if step == "journal":
        monkeypatch.setattr(listed, "put", die)
    elif step == "moves":
        monkeypatch.setattr(erasure, "_apply_journal", die)
    else:
        monkeypatch.setattr(listed, "delete", lambda s, p: die() if p.endswith(".parquet") else delete(s, p))
    with pytest.raises(RuntimeError):
        erasure.erase_stored(spark, {"people": table}, tickets, LINK, str(tmp_path / "audit"))
    monkeypatch.undo()
    erasure.erase_stored(spark, {"people": table}, tickets, LINK, str(tmp_path / "audit"))
    assert holders(spark, tmp_path, "people") == []
    assert rows(spark.read.parquet(table.path).select("n")) == sorted(
        [(n,) for n in range(40) if n % 8 != 3], key=repr)


def test_saved_keys_are_removed(spark, tmp_path, tickets, monkeypatch):
    scratch = tmp_path / "scratch"
    monkeypatch.setattr(erasure, "shared_dir", lambda _: str(scratch))
    erasure.erase_stored(spark, {"people": stored(spark, tmp_path)}, tickets, LINK, str(tmp_path / "audit"))
    assert not scratch.exists()


def test_no_file_of_a_copy_holds_the_subject(spark, tmp_path, tickets, rows):
    """Snapshot, changes after it, and parts that a compaction had replaced."""
    schema = "n bigint, who bigint, op string"
    spec = SyncSpec("", str(tmp_path / "copy"), ("n",), ("n",), op_column="op")

    def change(numbers, op="insert"):
        return spark.createDataFrame([(n, n % 8, op) for n in numbers], schema).repartitionByRange(3, "who")

    sync.write_changes(change(range(24)), 0, spec)
    sync.write_changes(change(range(24, 30)), 1, spec)
    sync.compact(spark, spec, change([0]).schema)
    sync.write_changes(change(range(30, 40)), 2, spec)
    sync.write_changes(change([4, 12]), 3, spec)
    sync.write_changes(change([5, 11], "delete"), 4, spec)
    assert holders(spark, tmp_path, "copy")
    copy = {"people": Stored(spec.target, change([0]).schema, is_listed=True)}
    erasure.erase_stored(spark, copy, tickets, LINK, str(tmp_path / "audit"))
    assert holders(spark, tmp_path, "copy") == []
    left = [(n,) for n in range(40) if n % 8 != 3]
    # A delete orders like the insert of its key here, so either may be the newest.
    got = [r for r in rows(sync.read_copy(spark, spec, change([0]).schema).select("n")) if r != (5,)]
    assert got == sorted([r for r in left if r != (5,)], key=repr)
    # The copy goes on as before: more changes, folding, clean-up.
    sync.write_changes(change([50]), 5, spec)
    sync.compact(spark, spec, change([0]).schema)
    listed.drop_superseded(spark, spec.target, 0)
    assert len(listed.live_entries(spark, spec.target)) == 1
    assert (50,) in rows(sync.read_copy(spark, spec, change([0]).schema).select("n"))
    assert holders(spark, tmp_path, "copy") == []


def test_empty_copy(spark, tmp_path, tickets):
    schema = spark.createDataFrame([], "n bigint, who bigint").schema
    copy = {"people": Stored(str(tmp_path / "none"), schema, is_listed=True)}
    erasure.erase_stored(spark, copy, tickets, LINK, str(tmp_path / "audit"))
    assert erasure.read_erasures(spark, str(tmp_path / "audit")).count() == 3
