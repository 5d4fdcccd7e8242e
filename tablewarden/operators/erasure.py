"""Erasure in storage: only files that hold a subject are rewritten, and the old ones go.

Finding the files reads one column. A folder of Parquet files is changed by a journal:
replacements are written out of readers' sight, a journal names old and new files, the new
ones are moved in and the old ones removed. An interrupted erasure is rolled forward by the
next one (`finish_erasures`). Between the two moves a reader may see a kept row twice,
never too few. The copy of a sync is a listed table, in which one new line swaps the
parts; superseded parts are removed with it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.context import shared_dir, small_or_shuffled
from tablewarden.operators.privacy import SubjectLink, _subject_keys, _walk, erasure_audit
from tablewarden.sources import listed
from tablewarden.sources.listed import Entry, file_system
from tablewarden.streaming.sync import CHANGES, SNAPSHOTS

FILES_AT_ONCE = 1_000
JOURNALS = "_erase"
ERASURES = "ticket string, table_name string, subject_id string, rows_removed bigint, ts timestamp, date date"


@dataclass(frozen=True)
class Stored:
    """Where a table of the walk lies: a folder of Parquet files, or the target of a sync."""

    path: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    is_listed: bool = False

    def parts(self, spark: SparkSession) -> list[str]:
        if not self.is_listed:
            return [self.path]
        return listed.paths_of(self.path, listed.live_entries(spark, self.path))

    def read(self, spark: SparkSession, paths: list[str] | None = None) -> DataFrame:
        """All rows in storage: of a copy also older versions and tombstones."""
        paths = self.parts(spark) if paths is None else paths
        if not paths:
            return spark.createDataFrame([], self.schema)
        reader = spark.read.schema(self.schema)
        if self.partition_by:
            reader = reader.option("basePath", self.path)
        return reader.parquet(*paths)


def _place(spark: SparkSession, path: str) -> str:
    """A path without scheme and host, to compare paths from different sources."""
    return file_system(spark, path)[1](path).toUri().getPath()


def _files_below(spark: SparkSession, folder: str) -> list[str]:
    """Data files below a folder (or the file itself), relative to it."""
    fs, kind = file_system(spark, folder)
    base, found = fs.makeQualified(kind(folder)).toUri().getPath(), []
    each = fs.listFiles(kind(folder), True)
    while each.hasNext():
        path = each.next().getPath()
        if not path.getName().startswith(("_", ".")):
            found.append(path.toUri().getPath()[len(base) :].lstrip("/"))
    return sorted(found)


def _files_with(
    spark: SparkSession, table: Stored, column: str, gone: DataFrame
) -> Iterator[str]:
    """Names of the files that hold a key of `gone`; they come one by one."""
    if not table.parts(spark):
        return
    seen = table.read(spark).select(column, F.col("_metadata.file_path").alias("_file"))
    hits = seen.join(gone, column, "left_semi").select("_file").distinct()
    for row in hits.toLocalIterator():
        yield row[0]


def _kept(spark: SparkSession, table: Stored, files: list[str], column: str, gone: DataFrame) -> DataFrame:
    rows = table.read(spark, files)
    return rows.join(gone, column, "left_anti").select(*table.schema.names)


def _apply_journal(spark: SparkSession, table: Stored, folder: str) -> None:
    """Move the new files in, then remove the old ones. May be repeated at any point."""
    fs, kind = file_system(spark, folder)
    [line] = spark.read.schema("old array<string>, new array<string>").json(f"{folder}/journal.json").collect()
    for name in line.new:
        source, target = kind(f"{folder}/new/{name}"), kind(f"{table.path}/{name}")
        if fs.exists(source):
            fs.mkdirs(target.getParent())
            fs.rename(source, target)
    for name in line.old:
        listed.delete(spark, f"{table.path}/{name}")
    listed.delete(spark, folder)


def finish_erasures(spark: SparkSession, table: Stored) -> None:
    """Roll erasures of a folder forward that were cut short; drafts without a journal are dropped."""
    fs, kind = file_system(spark, table.path)
    parent = kind(f"{table.path}/{JOURNALS}")
    if not fs.exists(parent):
        return
    for status in fs.listStatus(parent):
        folder = f"{table.path}/{JOURNALS}/{status.getPath().getName()}"
        if listed.exists(spark, f"{folder}/journal.json"):
            _apply_journal(spark, table, folder)
        else:
            listed.delete(spark, folder)
    listed.delete(spark, f"{table.path}/{JOURNALS}")


def _erase_folder(
    spark: SparkSession, table: Stored, column: str, gone: DataFrame, at_once: int
) -> None:
    base = _place(spark, table.path)
    names = _files_with(spark, table, column, gone)
    while chunk := list(islice(names, at_once)):
        folder = f"{table.path}/{JOURNALS}/{uuid.uuid4()}"
        writer = _kept(spark, table, chunk, column, gone).write
        if table.partition_by:
            writer = writer.partitionBy(*table.partition_by)
        writer.parquet(f"{folder}/new")
        journal = {"old": [_place(spark, f)[len(base) :].lstrip("/") for f in chunk],
                   "new": _files_below(spark, f"{folder}/new")}
        listed.put(spark, f"{folder}/journal.json", json.dumps(journal) + "\n")
        _apply_journal(spark, table, folder)
    listed.delete(spark, f"{table.path}/{JOURNALS}")


def _erase_listed(spark: SparkSession, table: Stored, column: str, gone: DataFrame) -> None:
    root = table.path
    hit = {_place(spark, f) for f in _files_with(spark, table, column, gone)}
    for entry in listed.live_entries(spark, root) if hit else []:
        files = [f"{p}/{f}" if f else p for p in entry.paths for f in _files_below(spark, f"{root}/{p}")]
        old = [f for f in files if _place(spark, f"{root}/{f}") in hit]
        if not old:
            continue
        part = listed.new_part(SNAPSHOTS if entry.snapshot else CHANGES, "erased")
        _kept(spark, table, [f"{root}/{f}" for f in old], column, gone).write.parquet(f"{root}/{part}")
        left = tuple(f for f in files if f not in set(old))
        listed.commit(spark, root, Entry(
            f"erased-{uuid.uuid4()}", (*left, part), entry.snapshot, (entry.name, *entry.folds)))
    # Parts that an earlier compaction has replaced may hold the subject too.
    listed.drop_superseded(spark, root, keep_seconds=0)


def append_erasures(audit: DataFrame, path: str, ts: Column) -> None:
    """Append (ticket, table_name, subject_id, rows_removed, ts) as JSON, in a folder for each day."""
    rows = audit.select("ticket", "table_name", F.col("subject_id").cast("string"), "rows_removed",
                        ts.cast("timestamp").alias("ts"))
    dated = rows.withColumn("date", F.to_date(F.to_utc_timestamp("ts", F.current_timezone())))
    dated.coalesce(1).write.mode("append").partitionBy("date").json(path)


def read_erasures(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ERASURES).json(path).drop("date")


def erase_stored(
    spark: SparkSession,
    stored: dict[str, Stored],
    tickets: DataFrame,
    links: dict[str, SubjectLink],
    audit_path: str,
    ts: Column | None = None,
    files_at_once: int = FILES_AT_ONCE,
) -> None:
    """Remove the subjects of `tickets(ticket, subject_id)` from all files, and append the audit.

    Synced copies belong into the walk beside their sources. Keys are resolved before
    anything is removed; the tables that hold them are deleted at the end, whatever
    happens. A ticket without a number is not carried out; one without a subject is
    audited with nothing removed. Run again after a failure: what is gone stays gone,
    and the audit then has what the second run removed.
    """
    scratch = shared_dir(spark)

    def save(df: DataFrame) -> DataFrame:
        path = f"{scratch}/{uuid.uuid4()}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    for table in stored.values():
        if not table.is_listed:
            finish_erasures(spark, table)
    try:
        tables = {name: table.read(spark) for name, table in stored.items()}
        accepted = save(tickets.filter(F.coalesce("ticket", F.lit("")) != "").select("ticket", "subject_id"))
        audit = save(erasure_audit(tables, accepted, links, save))
        keys = _subject_keys(tables, links, accepted, save)
        for name in _walk(links):
            table, column = stored[name], links[name].column
            gone = small_or_shuffled(save(keys[name].select(F.col("_key").alias(column)).distinct()))
            if table.is_listed:
                _erase_listed(spark, table, column, gone)
            else:
                _erase_folder(spark, table, column, gone, files_at_once)
        append_erasures(audit, audit_path, F.current_timestamp() if ts is None else ts)
    finally:
        listed.delete(spark, scratch)
