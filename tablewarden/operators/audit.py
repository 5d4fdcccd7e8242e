"""Deployment audit: timelines, rollbacks, gates and duties."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.context import cut_lineage, lookup_join, small_or_shuffled
from tablewarden.operators.ordered import GROUP_ROWS, previous_over_pieces, split_by_weight

AUDIT_SCHEMA = T.StructType([T.StructField("ts", T.TimestampType())])
for _name in (
    "bundle",
    "target",
    "git_sha",
    "actor",
    "ci_job_url",
    "ci_pipeline_id",
    "mr_iid",
    "change_ticket",
):
    AUDIT_SCHEMA.add(_name, "string")
TARGETS = ("dev", "staging", "prod")
TICKET_SHAPE = "^CHG-[0-9]+$"
BAKE_HOURS = 24


def deploy_timeline(
    audit: DataFrame, ts: str = "ts", sequence: str | None = None, max_rows: int = GROUP_ROWS
) -> DataFrame:
    """Each deploy with the sha it replaced and whether it rolled back.

    A rollback deploys a sha that this bundle and target had before, right after
    a different one. `sequence` breaks ties of `ts`, and the sha those that are
    left. A sha was had before if its first deploy has a lower order; null places
    and shas count as values. Timelines of moderate length take one shuffle;
    longer ones are cut into pieces and look up when their sha was first
    deployed, by the same definition.
    """
    place = ["bundle", "target"]
    order = [ts, "git_sha"] if sequence is None else [ts, sequence, "git_sha"]
    at = F.struct(*order)
    light, heavy = split_by_weight(audit, place, max_rows)
    line = Window.partitionBy(*place).orderBy(*order)
    same_sha = Window.partitionBy(*place, "git_sha")
    placed = light.withColumns(
        {
            "previous_sha": F.lag("git_sha").over(line),
            "_seen": at > F.min(at).over(same_sha),
        }
    )
    if heavy is not None:
        long = previous_over_pieces(heavy, place, order, {"previous_sha": "git_sha"})
        keys = [*place, "git_sha"]
        first = heavy.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(at).alias("_first"))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        placed = placed.unionByName(
            long.join(small_or_shuffled(cut_lineage(first)), same, "left")
            .withColumn("_seen", at > F.col("_first"))
            .drop("_first", *[f"_{k}" for k in keys])
        )
    changed = F.col("previous_sha") != F.col("git_sha")
    return placed.withColumn(
        "is_rollback", F.coalesce(changed & F.col("_seen"), F.lit(False))
    ).drop("_seen")


def rollbacks(timeline: DataFrame) -> DataFrame:
    return timeline.filter("is_rollback")


def bake_violations(audit: DataFrame, hours: int = BAKE_HOURS, ts: str = "ts") -> DataFrame:
    """Prod deploys of a sha that staging had not run for `hours` before."""
    staged = (
        audit.filter("target = 'staging'")
        .groupBy("bundle", "git_sha")
        .agg(F.min(ts).alias("staged_at"))
    )
    ready = F.col("staged_at") + F.make_dt_interval(hours=F.lit(hours))
    shipped = audit.filter("target = 'prod'")
    return (
        lookup_join(shipped, staged, ["bundle", "git_sha"], "left")
        .withColumn(
            "reason",
            F.when(
                F.isnull("staged_at") | (F.col("staged_at") > F.col(ts)), F.lit("not_staged")
            ).when(F.col(ts) < ready, F.lit("short_bake")),
        )
        .filter(F.col("reason").isNotNull())
    )


def sod_violations(deploys: DataFrame) -> DataFrame:
    """Prod deploys approved by their author, or by nobody."""
    return deploys.filter(
        (F.col("target") == "prod")
        & (F.isnull("approver") | F.col("approver").eqNullSafe(F.col("author")))
    )


def ticket_violations(deploys: DataFrame) -> DataFrame:
    """Deploys without a well-formed change ticket."""
    return deploys.filter(~F.coalesce(F.col("change_ticket").rlike(TICKET_SHAPE), F.lit(False)))
