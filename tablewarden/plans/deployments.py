"""Deployment audit with events as the log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.context import shared_dir
from tablewarden.functions.text import audit_key
from tablewarden.operators import audit
from tablewarden.plans.derived import frame, with_inputs
from tablewarden.sources.tables import append_audit, dump_csv, read_audit


def log(spark, d):
    return frame(spark, d, "deploys").select("event_id", "ts", "bundle", "target", "git_sha")


def deploy_timeline(spark, d):
    return _shown(audit.deploy_timeline(log(spark, d), sequence="event_id"))


def deploy_timeline_pieces(spark, d):
    """The same with every longer timeline cut into pieces, as a hot bundle's would be."""
    return _shown(audit.deploy_timeline(log(spark, d), sequence="event_id", max_rows=15))


def _shown(line):
    return line.select(
        "event_id", "bundle", "target", "git_sha",
        F.coalesce("previous_sha", F.lit("")).alias("previous_sha"), "is_rollback",
    )


def rollbacks(spark, d):
    found = audit.rollbacks(audit.deploy_timeline(log(spark, d), sequence="event_id"))
    return found.groupBy("bundle", "target").agg(F.count(F.lit(1)).alias("n_rollbacks"))


def bake_violations(spark, d):
    return audit.bake_violations(log(spark, d)).select("event_id", "bundle", "git_sha", "reason")


def sod_violations(spark, d):
    found = audit.sod_violations(frame(spark, d, "deploys"))
    return found.select("event_id", "author", F.coalesce("approver", F.lit("")).alias("approver"))


def ticket_violations(spark, d):
    return audit.ticket_violations(frame(spark, d, "deploys")).select("event_id", "change_ticket")


def audit_keys(spark, d):
    key = audit_key(F.col("target"), F.col("ts"), F.col("bundle"), F.col("git_sha"))
    return frame(spark, d, "deploys").select("event_id", key.alias("key"))


def records(spark, d):
    empty = F.lit("")
    return frame(spark, d, "deploys").select(
        F.col("ts").cast("timestamp").alias("ts"), "bundle", "target", "git_sha",
        F.col("author").alias("actor"), empty.alias("ci_job_url"), empty.alias("ci_pipeline_id"),
        empty.alias("mr_iid"), "change_ticket",
    )


def audit_sink(spark, d):
    """Written as partitioned JSON, read back for one target only."""
    path = shared_dir(spark) + "/audit"
    append_audit(records(spark, d), path)
    return (
        read_audit(spark, path)
        .filter("target = 'prod'")
        .groupBy("date", "actor")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def access_dump(spark, d):
    """Grants dumped as dated CSV and read back."""
    grants = frame(spark, d, "grant_rows").select("securable", "principal")
    path = dump_csv(grants, shared_dir(spark) + "/reviews", "2024-01-01", "grants")
    return spark.read.schema("securable string, principal string").csv(path, header=True)


QUERIES = {
    "deploy_timeline": deploy_timeline,
    "deploy_timeline_pieces": deploy_timeline_pieces,
    "rollbacks": rollbacks,
    "bake_violations": bake_violations,
    "sod_violations": sod_violations,
    "ticket_violations": ticket_violations,
    "audit_keys": audit_keys,
    "audit_sink": audit_sink,
    "access_dump": access_dump,
}

_D = with_inputs("deploys")
_LINE = """line AS (
    SELECT *, LAG(git_sha) OVER (PARTITION BY bundle, target ORDER BY ts, event_id) AS previous,
           ROW_NUMBER() OVER (PARTITION BY bundle, target, git_sha ORDER BY ts, event_id) AS nth
    FROM deploys)"""

_TIMELINE = f"""{_D}, {_LINE}
        SELECT event_id, bundle, target, git_sha, COALESCE(previous, '') AS previous_sha,
               COALESCE(previous <> git_sha AND nth > 1, FALSE) AS is_rollback
        FROM line"""

SQL = {
    "deploy_timeline": _TIMELINE,
    "deploy_timeline_pieces": _TIMELINE,
    "rollbacks": f"""{_D}, {_LINE}
        SELECT bundle, target, COUNT(*) AS n_rollbacks FROM line
        WHERE previous <> git_sha AND nth > 1 GROUP BY bundle, target""",
    "bake_violations": f"""{_D}
        SELECT p.event_id, p.bundle, p.git_sha,
               CASE WHEN s.first_ts IS NULL OR s.first_ts > p.ts THEN 'not_staged'
                    ELSE 'short_bake' END AS reason
        FROM deploys p LEFT JOIN (
            SELECT bundle, git_sha, MIN(ts) AS first_ts FROM deploys
            WHERE target = 'staging' GROUP BY bundle, git_sha) s
          ON s.bundle = p.bundle AND s.git_sha = p.git_sha
        WHERE p.target = 'prod'
          AND (s.first_ts IS NULL OR p.ts < s.first_ts + INTERVAL 24 HOUR)""",
    "sod_violations": f"""{_D}
        SELECT event_id, author, COALESCE(approver, '') AS approver FROM deploys
        WHERE target = 'prod' AND (approver IS NULL OR approver = author)""",
    "ticket_violations": f"""{_D} SELECT event_id, change_ticket FROM deploys
        WHERE NOT regexp_full_match(change_ticket, 'CHG-[0-9]+')""",
    "audit_keys": f"""{_D}
        SELECT event_id, target || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) || '/' || bundle || '-'
               || left(git_sha, 12) || '.json' AS key FROM deploys""",
    "audit_sink": f"""{_D}
        SELECT CAST(ts AS DATE) AS date, author AS actor, COUNT(*) AS n
        FROM deploys WHERE target = 'prod' GROUP BY ALL""",
    "access_dump": with_inputs("grant_rows") + " SELECT securable, principal FROM grant_rows",
}
