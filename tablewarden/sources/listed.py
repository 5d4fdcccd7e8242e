"""A folder of Parquet parts with a list of which of them count.

A writer first writes a part, then puts one small JSON file that names it into
`commits/` by a rename. Readers go by these files alone: never by folder names, batch
numbers or success markers. A file may say that it replaces others; that is how parts
are folded into a snapshot and how rows are erased. The rows of a table do not depend on
the order of its parts, so there are no versions and nothing to lock: two writers can at
worst leave rows twice, which a reader by key does not see.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

COMMITS = "commits"
_ENTRY = "name string, paths array<string>, snapshot boolean, folds array<string>, at double"


@dataclass(frozen=True)
class Entry:
    """One line of the list: parts (below the table's folder) and the entries they replace."""

    name: str
    paths: tuple[str, ...]
    snapshot: bool = False
    folds: tuple[str, ...] = ()
    at: float = 0.0


def file_system(spark: SparkSession, path: str):
    """The cluster's file system for a path, and the path class."""
    kind = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return kind(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), kind


def exists(spark: SparkSession, path: str) -> bool:
    fs, kind = file_system(spark, path)
    return fs.exists(kind(path))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; nothing happens if it is gone."""
    fs, kind = file_system(spark, path)
    fs.delete(kind(path), True)


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside `path` and rename it into place, so that it is never half there."""
    fs, kind = file_system(spark, path)
    folder, name = path.rsplit("/", 1)
    draft = kind(f"{folder}/.{name}-{uuid.uuid4()}")
    out = fs.create(draft, True)
    try:
        out.writeBytes(text)
    finally:
        out.close()
    if not fs.rename(draft, kind(path)):
        fs.delete(draft, False)
        if not fs.exists(kind(path)):
            raise OSError(f"cannot put {path} in place")


def new_part(kind: str, name: str = "part") -> str:
    """A path below the table that nobody has written to."""
    return f"{kind}/{name}-{uuid.uuid4()}"


def commit(spark: SparkSession, root: str, entry: Entry) -> None:
    line = {"name": entry.name, "paths": entry.paths, "snapshot": entry.snapshot,
            "folds": entry.folds, "at": time.time()}
    put(spark, f"{root}/{COMMITS}/{entry.name}.json", json.dumps(line) + "\n")


def is_committed(spark: SparkSession, root: str, name: str) -> bool:
    return exists(spark, f"{root}/{COMMITS}/{name}.json")


def all_entries(spark: SparkSession, root: str) -> list[Entry]:
    """Every entry, replaced ones included; as many as were committed since the last clean-up."""
    folder = f"{root}/{COMMITS}"
    if not exists(spark, folder):
        return []
    rows = spark.read.schema(_ENTRY).json(folder).orderBy("at", "name").collect()
    return [Entry(r.name, tuple(r.paths or ()), bool(r.snapshot), tuple(r.folds or ()), r.at or 0.0)
            for r in rows]


def live_entries(spark: SparkSession, root: str) -> list[Entry]:
    """The entries that no other one replaces, oldest first."""
    entries = all_entries(spark, root)
    folded = {name for e in entries for name in e.folds}
    return [e for e in entries if e.name not in folded]


def paths_of(root: str, entries: list[Entry]) -> list[str]:
    return [f"{root}/{p}" for e in entries for p in e.paths]


def drop_superseded(spark: SparkSession, root: str, keep_seconds: float = 3_600) -> int:
    """Remove replaced parts, and the list's lines for them; returns how many lines went.

    Parts replaced less than `keep_seconds` ago stay for readers that have begun. Every
    replacing entry names all that came before it, so lines may go in any order. An
    interrupted run is finished by the next one: a line goes after its parts.
    """
    entries = all_entries(spark, root)
    replaced_at = {}
    for e in entries:
        for name in e.folds:
            replaced_at[name] = min(e.at, replaced_at.get(name, e.at))
    live = [e for e in entries if e.name not in replaced_at]
    used = {p for e in live for p in e.paths}
    gone = [e for e in entries
            if e.name in replaced_at and replaced_at[e.name] <= time.time() - keep_seconds]
    for e in gone:
        for path in e.paths:
            # A folder of which only some files were replaced loses just those.
            if path in used:
                continue
            inner = [p for p in used if p.startswith(f"{path}/")]
            if not inner:
                delete(spark, f"{root}/{path}")
                continue
            fs, kind = file_system(spark, root)
            for status in fs.listStatus(kind(f"{root}/{path}")):
                name = status.getPath().getName()
                if f"{path}/{name}" not in used:
                    fs.delete(status.getPath(), True)
        delete(spark, f"{root}/{COMMITS}/{e.name}.json")
    return len(gone)


def drop_unlisted(spark: SparkSession, root: str, kinds: tuple[str, ...], older_seconds: float) -> int:
    """Remove parts that no line names, left by writers that died; young ones may be in the making."""
    fs, kind = file_system(spark, root)
    named = {p for e in all_entries(spark, root) for p in e.paths}
    limit, dropped = (time.time() - older_seconds) * 1000, 0
    for folder in kinds:
        if not fs.exists(kind(f"{root}/{folder}")):
            continue
        for status in fs.listStatus(kind(f"{root}/{folder}")):
            part = f"{folder}/{status.getPath().getName()}"
            held = part in named or any(p.startswith(f"{part}/") for p in named)
            if not held and status.getModificationTime() <= limit:
                fs.delete(status.getPath(), True)
                dropped += 1
    return dropped
