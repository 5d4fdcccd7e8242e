"""Who is asking, in which environment, and what is synced where."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from contextvars import ContextVar
from dataclasses import dataclass, field
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.sources import listed

ENVIRONMENTS = ("dev", "staging", "prod")


@dataclass(frozen=True)
class Caller:
    """The identity a governed frame is built for.

    Spark has no account groups of its own, so the caller is always passed in.
    """

    user: str
    groups: frozenset[str] = field(default_factory=frozenset)

    def member_of(self, group: str) -> bool:
        return group in self.groups


@dataclass(frozen=True)
class Env:
    """One deployment environment: a base path, a region, and its group names."""

    name: str
    base: str = ""
    region: str = "ap-southeast-1"
    group_prefix: str = ""

    def __post_init__(self):
        if self.name not in ENVIRONMENTS:
            raise ValueError(f"unknown environment {self.name!r}; expected one of {ENVIRONMENTS}")

    def group(self, role: str) -> str:
        return f"{self.group_prefix}{role}_{self.name}"

    @property
    def readers(self) -> str:
        return self.group("pii_readers")

    def path(self, table: str) -> str:
        """`orders` -> base/orders.parquet, `silver.orders` -> base/silver/orders.parquet."""
        return f"{self.base}/{table.replace('.', '/')}.parquet"


@dataclass(frozen=True)
class SyncSpec:
    """A keyed copy of `source` kept at `target`."""

    source: str
    target: str
    primary_key_columns: tuple[str, ...]
    order_columns: tuple[str, ...]
    scheduling_policy: str = "TRIGGERED"
    op_column: str | None = None
    delete_value: str = "delete"

    def __post_init__(self):
        if self.scheduling_policy not in ("TRIGGERED", "CONTINUOUS"):
            raise ValueError(f"unknown scheduling policy {self.scheduling_policy!r}")


@cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder every executor can reach.

    Below `spark.checkpoint.dir`. Only a local session, which is its own
    cluster, may fall back to a folder on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/run-{uuid.uuid4()}"


@cache
def _shipped(application: str) -> str:
    """This package as a zip file in the driver's temporary folder."""
    package = Path(__file__).resolve().parent
    archive = f"{tempfile.mkdtemp(prefix='tablewarden-')}/tablewarden.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    return archive


_sent: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, for functions that run there; once per application."""
    application = spark.sparkContext.applicationId
    if application not in _sent:
        spark.sparkContext.addPyFile(_shipped(application))
        _sent.add(application)


#: The folders of the frames cut on the way to a result that will be `settled`.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` as a table in the shared folder and read it back.

    It survives the loss of executors. Columns can be pruned when it is read,
    and its rows are counted from file footers.
    """
    folder = shared_dir(df.sparkSession)
    passing = _passing.get()
    if passing is not None:
        passing.append(folder)
    path = f"{folder}/frame"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """`cut_lineage` of the frame that `make` gives; those it has cut on the way are removed.

    Nothing else that is made inside may be read afterwards.
    """
    folders: list[str] = []
    try:
        token = _passing.set(folders)
        try:
            made = make()
        finally:
            _passing.reset(token)
        return cut_lineage(made)
    finally:
        for folder in folders:
            listed.delete(spark, folder)


def is_small(df: DataFrame, max_rows: int = 100_000) -> bool:
    """Whether the frame has at most `max_rows` rows. A plain count, so no task sees them all."""
    return df.count() <= max_rows


def small_or_shuffled(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast a narrow key frame only after counting that it is small; else leave it to Spark."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def lookup_join(
    facts: DataFrame, lookup: DataFrame, keys: list[str], how: str, max_rows: int = 100_000
) -> DataFrame:
    """Join rows, whose keys may be very uneven, with a frame that has each key once.

    The lookup is materialised first, which settles two things. Its size is
    known: a small one is broadcast and the rows are not shuffled at all. And a
    large one is read back as it is, so both inputs of the join are plain
    shuffles, the form in which adaptive execution splits a skewed partition;
    it would not below an aggregate. Columns keep the order of `facts`.
    """
    kept = small_or_shuffled(cut_lineage(lookup), max_rows)
    added = [] if how in ("left_semi", "left_anti") else [c for c in lookup.columns if c not in keys]
    return facts.join(kept, keys, how).select(*facts.columns, *added)


def bounded_values(df: DataFrame, column: str, max_rows: int = 1_000) -> list | None:
    """The distinct non-null values of a column, or None when there are too many to inline."""
    rows = (
        df.select(column).filter(F.col(column).isNotNull()).distinct().limit(max_rows + 1).collect()
    )
    if len(rows) > max_rows:
        return None
    return sorted(row[0] for row in rows)
