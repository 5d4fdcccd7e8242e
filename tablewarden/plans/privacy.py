"""Erasure, subject access, retention, residency and secrets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablewarden.functions.calendar import (
    add_business_days,
    business_days,
    next_review_date,
    retention_due_date,
)
from tablewarden.context import SyncSpec, shared_dir
from tablewarden.operators import corpus, erasure, privacy
from tablewarden.operators.erasure import Stored
from tablewarden.operators.privacy import SubjectLink
from tablewarden.plans.derived import frame, table, with_inputs
from tablewarden.streaming import sync

LINKS = {
    "customer": SubjectLink("c_custkey"),
    "orders": SubjectLink("o_custkey"),
    "lineitem": SubjectLink("l_orderkey", parent="orders", parent_key="o_orderkey"),
}
AS_OF = dt.date(2001, 12, 31)
HOLIDAYS = [dt.date(1998, 1, 1), dt.date(1998, 12, 25), dt.date(1999, 1, 1), dt.date(2000, 5, 1)]
TOKEN = {**corpus.SECRET_PATTERNS, "assigned_token": 'token = "[0-9a-f]{40}"'}


def tables(spark, d):
    return {name: table(spark, d, name) for name in LINKS}


def erase_orders(spark, d):
    left = privacy.erase(tables(spark, d), frame(spark, d, "tickets"), LINKS)
    return left["orders"].select("o_orderkey", "o_custkey")


def erase_lineitem(spark, d):
    left = privacy.erase(tables(spark, d), frame(spark, d, "tickets"), LINKS)
    return left["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def erasure_audit(spark, d):
    return privacy.erasure_audit(tables(spark, d), frame(spark, d, "tickets"), LINKS)


def stored_tables(spark, d, root):
    """The tables as files that may be changed; orders lie in partitions."""
    stored = {}
    for name, df in tables(spark, d).items():
        by = ("o_orderstatus",) if name == "orders" else ()
        stored[name] = Stored(f"{root}/{name}", df.schema, by)
        df.write.partitionBy(*by).parquet(f"{root}/{name}") if by else df.write.parquet(f"{root}/{name}")
    return stored


def erase_stored(spark, d):
    """Orders after the files with a subject were rewritten in place."""
    root = shared_dir(spark)
    stored = stored_tables(spark, d, root)
    erasure.erase_stored(spark, stored, frame(spark, d, "tickets"), LINKS, f"{root}/audit")
    return stored["orders"].read(spark).select("o_orderkey", "o_custkey", "o_orderstatus")


def erasure_log(spark, d):
    """The audit of that erasure as appended; one ticket names nobody."""
    root = shared_dir(spark)
    nobody = spark.range(1).select(F.lit("T-none").alias("ticket"), F.lit(None).cast("long").alias("subject_id"))
    asked = frame(spark, d, "tickets").unionByName(nobody)
    at = F.lit("2001-12-31 12:00:00")
    erasure.erase_stored(spark, stored_tables(spark, d, root), asked, LINKS, f"{root}/audit", at)
    log = erasure.read_erasures(spark, f"{root}/audit")
    return log.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


def erase_copy(spark, d):
    """A synced copy, partly compacted, from which the subjects are erased; then read back."""
    root = shared_dir(spark)
    events = table(spark, d, "events")
    spec = SyncSpec(f"{d}/events*.parquet", f"{root}/copy", ("user_id",), ("ts", "event_id"),
                    op_column="event_type", delete_value="error")
    sync.write_changes(events.filter("value < 50"), 0, spec)
    sync.compact(spark, spec, events.schema)
    sync.sync_triggered(sync.read_changes(spark, spec, events.schema), spec, f"{root}/checkpoint")
    copy = {"events": Stored(spec.target, events.schema, is_listed=True)}
    erasure.erase_stored(spark, copy, frame(spark, d, "tickets"), {"events": SubjectLink("user_id")},
                         f"{root}/audit")
    return sync.read_copy(spark, spec, events.schema).select("user_id", "event_id", "event_type", "value")


def erasure_overdue(spark, d):
    late = privacy.erasure_overdue(frame(spark, d, "cases"), AS_OF)
    return late.select("ticket", "opened", "business_days")


def subject_access(spark, d):
    shown = {
        "customer": table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"),
        "orders": table(spark, d, "orders").select(
            "o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice")
        ),
        "lineitem": table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag"),
    }
    return privacy.subject_access(shown, frame(spark, d, "tickets"), LINKS)


def retention_due(spark, d):
    orders = table(spark, d, "orders").withMetadata("o_totalprice", {"retention_days": 1825})
    tagged = orders.withMetadata("o_custkey", {"retention_days": 730})
    due = privacy.retention_due(tagged, "o_orderdate", AS_OF)
    return due.select("o_orderkey", "o_orderdate")


def log_retention(spark, d):
    items = table(spark, d, "lineitem")
    kinds = [
        privacy.log_retention_due(items, "l_shipdate", dt.date(2004, 2, 29), kind)
        .groupBy("l_returnflag")
        .agg(F.count(F.lit(1)).alias("n_due"))
        .withColumn("kind", F.lit(kind))
        for kind in privacy.LOG_RETENTION_YEARS
    ]
    return kinds[0].unionByName(kinds[1])


def residency_scan(spark, d):
    found = privacy.residency_violations(frame(spark, d, "storage_paths"), "path")
    return found.select("id", F.array_join("regions", ",").alias("regions"))


def secret_scan(spark, d):
    return corpus.secret_scan(table(spark, d, "documents"), "text", TOKEN, path="doc_id").withColumn(
        "n_matches", F.col("n_matches").cast("bigint")
    )


def dates(spark, d):
    """Per order: due and review dates, and business days until the end of its year."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").select(
        "o_orderkey",
        retention_due_date(F.col("o_orderdate"), F.lit(90)).alias("due"),
        next_review_date(day).alias("review"),
        business_days(day, F.lit(AS_OF), HOLIDAYS).alias("business_days"),
        add_business_days(day, 15).alias("limit_day"),
        add_business_days(day, 5, HOLIDAYS).alias("answer_day"),
    )


QUERIES = {
    "erase_orders": erase_orders,
    "erase_lineitem": erase_lineitem,
    "erasure_audit": erasure_audit,
    "erase_stored": erase_stored,
    "erasure_log": erasure_log,
    "erase_copy": erase_copy,
    "erasure_overdue": erasure_overdue,
    "subject_access": subject_access,
    "retention_due": retention_due,
    "log_retention": log_retention,
    "residency_scan": residency_scan,
    "secret_scan": secret_scan,
    "calendar_dates": dates,
}

_T = with_inputs("tickets")

SQL = {
    "erase_orders": f"""{_T} SELECT o_orderkey, o_custkey FROM orders
        WHERE o_custkey NOT IN (SELECT subject_id FROM tickets)""",
    "erase_lineitem": f"""{_T} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders
                                 WHERE o_custkey IN (SELECT subject_id FROM tickets))""",
    "erasure_audit": f"""{_T}, hits AS (
        SELECT 'customer' AS table_name, c_custkey AS subject_id FROM customer
        UNION ALL SELECT 'orders', o_custkey FROM orders
        UNION ALL SELECT 'lineitem', o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
        SELECT t.ticket, n.table_name, t.subject_id, COUNT(h.subject_id) AS rows_removed
        FROM tickets t
        CROSS JOIN (VALUES ('customer'), ('orders'), ('lineitem')) n(table_name)
        LEFT JOIN hits h ON h.subject_id = t.subject_id AND h.table_name = n.table_name
        GROUP BY ALL""",
    "erase_stored": f"""{_T} SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
        WHERE o_custkey NOT IN (SELECT subject_id FROM tickets)""",
    "erasure_log": f"""{_T}, asked AS (
        SELECT ticket, subject_id FROM tickets UNION ALL SELECT 'T-none', NULL), hits AS (
        SELECT 'customer' AS table_name, c_custkey AS subject_id FROM customer
        UNION ALL SELECT 'orders', o_custkey FROM orders
        UNION ALL SELECT 'lineitem', o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
        SELECT t.ticket, n.table_name, CAST(t.subject_id AS VARCHAR) AS subject_id,
               COUNT(h.subject_id) AS rows_removed, '2001-12-31 12:00:00' AS ts
        FROM asked t
        CROSS JOIN (VALUES ('customer'), ('orders'), ('lineitem')) n(table_name)
        LEFT JOIN hits h ON h.subject_id = t.subject_id AND h.table_name = n.table_name
        GROUP BY ALL""",
    "erase_copy": f"""{_T}, newest AS (
        SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id)
        SELECT e.user_id, e.event_id, e.event_type, e.value
        FROM newest n JOIN events e ON e.event_id = n.event_id
        WHERE e.event_type <> 'error' AND e.user_id NOT IN (SELECT subject_id FROM tickets)""",
    "erasure_overdue": with_inputs("cases")
    + """, weekdays AS (
            SELECT day, SUM(CASE WHEN isodow(day) < 6 THEN 1 ELSE 0 END) OVER (ORDER BY day) AS n
            FROM (SELECT CAST(range AS DATE) AS day
                  FROM range(DATE '1990-01-01', DATE '2010-01-01', INTERVAL 1 DAY))),
        counted AS (
            SELECT ticket, opened, CAST(b.n - a.n AS INT) AS business_days
            FROM cases JOIN weekdays a ON a.day = opened
                       JOIN weekdays b ON b.day = COALESCE(confirmed, DATE '2001-12-31'))
        SELECT * FROM counted WHERE business_days > 15""",
    "subject_access": f"""{_T}
        SELECT 'customer' AS table_name, c_custkey AS subject_id,
               '{{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"'
               || c_mktsegment || '"}}' AS record
        FROM customer WHERE c_custkey IN (SELECT subject_id FROM tickets)
        UNION ALL
        SELECT 'orders', o_custkey, '{{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey
               || ',"o_totalprice":' || CAST(o_totalprice AS DECIMAL(18,2)) || '}}'
        FROM orders WHERE o_custkey IN (SELECT subject_id FROM tickets)
        UNION ALL
        SELECT 'lineitem', o_custkey, '{{"l_orderkey":' || l_orderkey || ',"l_partkey":'
               || l_partkey || ',"l_returnflag":"' || l_returnflag || '"}}'
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE o_custkey IN (SELECT subject_id FROM tickets)""",
    "retention_due": """SELECT o_orderkey, o_orderdate FROM orders
        WHERE CAST(o_orderdate AS DATE) + 730 < DATE '2001-12-31'""",
    "log_retention": """
        SELECT 'system_access' AS kind, l_returnflag, COUNT(*) AS n_due FROM lineitem
        WHERE l_shipdate < DATE '1997-02-28' GROUP BY l_returnflag
        UNION ALL
        SELECT 'data_lineage', l_returnflag, COUNT(*) FROM lineitem
        WHERE l_shipdate < DATE '2002-02-28' GROUP BY l_returnflag""",
    "residency_scan": with_inputs("storage_paths")
    + """ SELECT id, regexp_extract(path, '-([a-z]+-[a-z]+-[0-9])/raw', 1) AS regions
        FROM storage_paths WHERE path NOT LIKE '%-ap-southeast-1/raw%'""",
    "secret_scan": """
        SELECT doc_id, 'assigned_token' AS kind,
               CAST(len(regexp_extract_all(text, 'token = "[0-9a-f]{40}"')) AS BIGINT) AS n_matches
        FROM documents WHERE regexp_matches(text, 'token = "[0-9a-f]{40}"')
        UNION ALL
        SELECT doc_id, 'private_key',
               CAST(len(regexp_extract_all(text, '-----BEGIN [A-Z ]*PRIVATE KEY( BLOCK)?-----'))
                    AS BIGINT)
        FROM documents WHERE regexp_matches(text, '-----BEGIN [A-Z ]*PRIVATE KEY')""",
    "calendar_dates": """WITH days AS (
            SELECT CAST(range AS DATE) AS day,
                   CASE WHEN isodow(range) < 6 THEN 1 ELSE 0 END AS weekday,
                   CASE WHEN isodow(range) < 6 AND CAST(range AS DATE) NOT IN (DATE '1998-01-01',
                        DATE '1998-12-25', DATE '1999-01-01', DATE '2000-05-01')
                        THEN 1 ELSE 0 END AS workday
            FROM range(DATE '1990-01-01', DATE '2010-01-01', INTERVAL 1 DAY)),
        numbered AS (
            SELECT day, weekday, workday, SUM(weekday) OVER (ORDER BY day) AS n,
                   SUM(workday) OVER (ORDER BY day) AS m FROM days),
        reviews AS (
            SELECT MIN(day) AS day FROM days
            WHERE isodow(day) = 1 AND month(day) IN (1, 4, 7, 10) AND day(day) <= 7
            GROUP BY year(day), month(day)),
        ordered AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders),
        per_day AS (
            SELECT d.day, d.day + 90 AS due,
                   (SELECT MIN(r.day) FROM reviews r WHERE r.day >= d.day) AS review,
                   CAST((SELECT m FROM numbered WHERE day = DATE '2001-12-31') - d.m AS INT)
                       AS business_days,
                   (SELECT x.day FROM numbered x WHERE x.weekday = 1 AND x.n = d.n + 15)
                       AS limit_day,
                   (SELECT x.day FROM numbered x WHERE x.workday = 1 AND x.m = d.m + 5)
                       AS answer_day
            FROM numbered d WHERE d.day IN (SELECT day FROM ordered))
        SELECT o.o_orderkey, p.due, p.review, p.business_days, p.limit_day, p.answer_day
        FROM ordered o JOIN per_day p ON p.day = o.day""",
}
