"""Erasure, subject access, retention and residency."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.context import cut_lineage, is_small, small_or_shuffled
from tablewarden.functions.calendar import business_days

# The erasure limit and how long logs are kept.
ERASURE_LIMIT_DAYS = 15
LOG_RETENTION_YEARS = {"system_access": 7, "data_lineage": 2}
PINNED_REGION = "ap-southeast-1"
REGION_TOKEN = (
    r"(?<![A-Za-z0-9])(?:us|eu|ap|sa|ca|me|af|il|mx|cn)(?:-gov)?-"
    r"(?:north|south|east|west|central)(?:east|west)?-[0-9]+(?![A-Za-z0-9])"
)


@dataclass(frozen=True)
class SubjectLink:
    """How a table points at a subject: by its own column, or through a parent's key."""

    column: str
    parent: str | None = None
    parent_key: str | None = None


def _walk(links: dict[str, SubjectLink]) -> list[str]:
    """Tables with children before parents, so an interrupted erasure can be resumed."""

    def depth(name: str) -> int:
        parent = links[name].parent
        return 0 if parent is None else 1 + depth(parent)

    return sorted(links, key=lambda n: (-depth(n), n))


def _subject_keys(
    tables: dict[str, DataFrame],
    links: dict[str, SubjectLink],
    subjects: DataFrame,
    save: Callable[[DataFrame], DataFrame] = cut_lineage,
) -> dict[str, DataFrame]:
    """Per table the distinct (_key, subject_id) its link column has for the subjects.

    Subjects, and keys reached through a parent, are resolved once and kept by
    `save`, else in the checkpoint folder: every table of the walk uses the same
    set, and its size is known before it is broadcast.
    """
    who = save(subjects.select("subject_id").dropna().distinct())
    found: dict[str, DataFrame] = {}
    for name in reversed(_walk(links)):
        link = links[name]
        if link.parent is None:
            found[name] = who.select(F.col("subject_id").alias("_key"), "subject_id")
            continue
        parent = tables[link.parent].select(
            F.col(links[link.parent].column).alias("_key"), F.col(link.parent_key).alias("_child")
        )
        found[name] = save(
            parent.join(small_or_shuffled(found[link.parent]), "_key")
            .select(F.col("_child").alias("_key"), "subject_id")
            .distinct()
        )
    return found


def erase(
    tables: dict[str, DataFrame], subjects: DataFrame, links: dict[str, SubjectLink]
) -> dict[str, DataFrame]:
    """Each table without the rows of `subjects(subject_id)`, children first.

    Few keys are broadcast, so the tables are filtered where they are read;
    otherwise both sides are shuffled by key.
    """
    keys = _subject_keys(tables, links, subjects)
    remaining = {}
    for name in _walk(links):
        column = links[name].column
        gone = keys[name].select(F.col("_key").alias(column))
        kept = tables[name].join(small_or_shuffled(gone), column, "left_anti")
        remaining[name] = kept.select(*tables[name].columns)
    return remaining


def erasure_audit(
    tables: dict[str, DataFrame],
    tickets: DataFrame,
    links: dict[str, SubjectLink],
    save: Callable[[DataFrame], DataFrame] = cut_lineage,
) -> DataFrame:
    """Rows to remove per ticket, subject and table, zero included. `tickets(ticket, subject_id)`.

    A ticket without a subject has its rows too, with nothing to remove.

    Few keys: rows are picked by a broadcast join and counted with partial sums.
    Many keys: rows are first counted per link value, so that a subject who owns
    much of a table costs one row per task in the shuffle.
    """
    accepted = save(
        tickets.filter(F.coalesce("ticket", F.lit("")) != "").select("ticket", "subject_id")
    )
    keys = _subject_keys(tables, links, accepted, save)
    counted = []
    for name in _walk(links):
        rows = tables[name].select(F.col(links[name].column).alias("_key"))
        if is_small(keys[name]):
            hits = rows.join(F.broadcast(keys[name]), "_key").withColumn(
                "_rows", F.lit(1).cast("bigint")
            )
        else:
            per_key = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows"))
            hits = keys[name].join(per_key, "_key")
        counted.append(hits.select(F.lit(name).alias("table_name"), "subject_id", "_rows"))
    asked = [
        accepted.select(
            F.lit(name).alias("table_name"), "subject_id", F.lit(0).cast("bigint").alias("_rows")
        )
        for name in links
    ]
    removed = (
        reduce(DataFrame.unionByName, counted + asked)
        .groupBy("table_name", "subject_id")
        .agg(F.sum("_rows").alias("rows_removed"))
    )
    return accepted.join(
        removed.withColumnRenamed("subject_id", "_who"), F.col("subject_id").eqNullSafe(F.col("_who"))
    ).select("ticket", "table_name", "subject_id", "rows_removed")


def subject_access(
    tables: dict[str, DataFrame], subjects: DataFrame, links: dict[str, SubjectLink]
) -> DataFrame:
    """Every row of the subjects, from every table, as JSON: (table_name, subject_id, record)."""
    keys = _subject_keys(tables, links, subjects)
    parts = []
    for name in _walk(links):
        df, column = tables[name], links[name].column
        wanted = small_or_shuffled(keys[name].withColumnRenamed("_key", column))
        parts.append(
            df.join(wanted, column).select(
                F.lit(name).alias("table_name"),
                "subject_id",
                F.to_json(F.struct(*df.columns)).alias("record"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def erasure_overdue(
    tickets: DataFrame,
    as_of: dt.date,
    limit: int = ERASURE_LIMIT_DAYS,
    holidays: list[dt.date] | None = None,
) -> DataFrame:
    """Tickets that took, or are taking, more business days than allowed.

    `tickets(ticket, subject_id, opened, confirmed)`; open ones count up to `as_of`.
    """
    until = F.coalesce("confirmed", F.lit(as_of))
    return tickets.withColumn(
        "business_days", business_days(F.col("opened"), until, holidays)
    ).filter(F.col("business_days") > limit)


def shortest_retention(schema: T.StructType) -> int | None:
    """The smallest `retention_days` any column of the table declares."""
    days = [f.metadata["retention_days"] for f in schema.fields if f.metadata.get("retention_days")]
    return min(days) if days else None


def _older_than(df: DataFrame, ts: str, day: dt.date) -> Column:
    """Compared on the stored type, so the predicate reaches the Parquet scan."""
    return F.col(ts) < F.lit(day).cast(df.schema[ts].dataType)


def retention_due(
    df: DataFrame, ts: str, as_of: dt.date, days: int | None = None
) -> DataFrame:
    """Rows whose due date (event date + days) lies before `as_of`."""
    keep = shortest_retention(df.schema) if days is None else days
    if keep is None or keep <= 0:
        raise ValueError("no retention period declared")
    return df.filter(_older_than(df, ts, as_of - dt.timedelta(days=keep)))


def log_retention_due(df: DataFrame, ts: str, as_of: dt.date, kind: str) -> DataFrame:
    """Log rows older than their class keeps."""
    years = LOG_RETENTION_YEARS[kind]
    try:
        cutoff = as_of.replace(year=as_of.year - years)
    except ValueError:  # 29 February
        cutoff = as_of.replace(year=as_of.year - years, day=28)
    return df.filter(_older_than(df, ts, cutoff))


def residency_violations(
    df: DataFrame, col: str, region: str = PINNED_REGION, pattern: str = REGION_TOKEN
) -> DataFrame:
    """Rows that name a region other than the pinned one, with the regions as `regions`."""
    named = F.array_distinct(F.regexp_extract_all(F.col(col), F.lit(pattern), F.lit(0)))
    return df.withColumn(
        "regions", F.array_sort(F.array_except(named, F.array(F.lit(region))))
    ).filter(F.size("regions") > 0)
