"""Caller-dependent reads over customers and their orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.context import Caller, Env, shared_dir
from tablewarden.functions.masks import register_masks
from tablewarden.jobs import TAGS
from tablewarden.operators import access, contract
from tablewarden.operators.marts import build_customer_360
from tablewarden.plans.derived import frame, table, with_inputs
from tablewarden.sources.tables import read_scope

ENV = Env("prod")
READER = Caller("grace", frozenset({"pii_readers_prod"}))
ANALYST = Caller("alice", frozenset({"finance_team_prod"}))
UNSCOPED = Caller("uma", frozenset({"finance_team_prod"}))
STRANGER = Caller("bob", frozenset({"marketing_prod"}))
CALLERS = {"reader": READER, "analyst": ANALYST, "unscoped": UNSCOPED, "stranger": STRANGER}

SCOPE = [("alice", "BUILDING"), ("alice", "MACHINERY"), ("carol", "FURNITURE")]
GRANTS = [
    ("lake.gold", "finance_team_prod", ["SELECT"]),
    ("lake.gold.customer_360", "pii_readers_prod", ["SELECT", "MODIFY"]),
    ("lake", "marketing_prod", ["SELECT"]),
]
EVENT_GRANTS = [
    ("lake.silver", "BUILDING", ["SELECT"]),
    ("lake.silver.click", "MACHINERY", ["SELECT", "MODIFY"]),
    ("lake", "HOUSEHOLD", ["SELECT"]),
    ("lake.silver.error", "u7", ["MODIFY"]),
]
C360 = """c360 AS (
    SELECT c_custkey AS customer_id, c_name AS email, c_mktsegment AS segment,
           CAST(COALESCE(spent, 0) AS DECIMAL(18,2)) AS lifetime_value
    FROM customer LEFT JOIN (
        SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS spent
        FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey)"""


def customer_360(spark: SparkSession, d: str) -> DataFrame:
    mart = build_customer_360(table(spark, d, "customer"), table(spark, d, "orders"))
    return contract.apply_tags(mart, TAGS)


def scope(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SCOPE, "user_email string, segment string")


def grants(spark: SparkSession, rows=GRANTS) -> DataFrame:
    return spark.createDataFrame(rows, "securable string, principal string, privileges array<string>")


def governed(spark: SparkSession, d: str, caller: Caller) -> DataFrame:
    """One caller's view: grant check, scope on the raw segment, masks."""
    mart = customer_360(spark, d)
    access.require_privilege(grants(spark), caller, "lake.gold.customer_360", "SELECT")
    mine = access.filter_by_scope(mart, "segment", caller, ENV, scope(spark))
    return access.apply_masks(mine, caller, ENV)


def governed_read(spark: SparkSession, d: str) -> DataFrame:
    return governed(spark, d, ANALYST)


def governed_read_callers(spark: SparkSession, d: str) -> DataFrame:
    """All caller classes over one mart, with what each of them gets to see."""
    parts = [
        governed(spark, d, caller).withColumn("caller", F.lit(name))
        for name, caller in CALLERS.items()
    ]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("caller", "segment")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("email") == "REDACTED").alias("n_redacted"),
            F.sum("lifetime_value").cast("decimal(18,2)").alias("lifetime_value"),
        )
    )


def scope_seed(spark: SparkSession, d: str) -> DataFrame:
    """The scope as a CSV seed: written out of customers, a row each, and read by its schema."""
    path = f"{shared_dir(spark)}/scope"
    seed = table(spark, d, "customer").select(
        F.concat("c_name", F.lit("@corp.example")).alias("user_email"),
        F.col("c_mktsegment").alias("cost_centre"))
    seed.write.csv(path, header=True)
    return read_scope(spark, path)


def governed_seed_read(spark: SparkSession, d: str) -> DataFrame:
    """The operator as a user calls it: grants, a row filter by its name, the scope from the seed."""
    caller = Caller("alice", frozenset({"finance_team_prod"}))
    path = f"{shared_dir(spark)}/scope"
    user = F.when(F.startswith("c_mktsegment", F.lit("M")), "alice").otherwise("carol")
    seed = table(spark, d, "customer").select(
        user.alias("user_email"), F.col("c_mktsegment").alias("cost_centre")).distinct()
    seed.write.csv(path, header=True)
    return access.governed_read(
        customer_360(spark, d), "lake.gold.customer_360", caller, ENV, grants(spark),
        read_scope(spark, path), ("security.filter_by_cost_centre", ["segment"]))


def mask_pii(spark: SparkSession, d: str) -> DataFrame:
    tagged = contract.apply_tags(table(spark, d, "customer"), {"c_name": TAGS["email"]})
    return access.apply_masks(tagged, STRANGER, ENV).select("c_custkey", "c_name", "c_mktsegment")


def apply_masks(spark: SparkSession, d: str) -> DataFrame:
    tags = {"email": TAGS["email"], "lifetime_value": TAGS["email"]}
    masked = access.apply_masks(contract.apply_tags(customer_360(spark, d), tags), STRANGER, ENV)
    # A hidden number is null; shown as a flag so that engines need not agree on null numbers.
    return masked.select(
        "customer_id", "email", "segment", F.isnull("lifetime_value").alias("value_hidden")
    )


def masked_view(spark: SparkSession, d: str) -> DataFrame:
    def view(caller: Caller) -> DataFrame:
        return access.masked_view(
            customer_360(spark, d),
            ["customer_id", "segment", "lifetime_value"],
            ["email"],
            {"grace", "ops"},
            caller,
        ).withColumn("seen_by", F.lit(caller.user))

    return view(READER).unionByName(view(STRANGER))


def sql_mask_function(spark: SparkSession, d: str) -> DataFrame:
    register_masks(spark, STRANGER, ENV, "mask_text")
    register_masks(spark, READER, ENV, "show_text")
    table(spark, d, "supplier").createOrReplaceTempView("_masked_supplier")
    return spark.sql(
        "SELECT s_suppkey, mask_text(s_name) AS hidden, show_text(s_name) AS shown "
        "FROM _masked_supplier"
    )


def row_filter_scope(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").withColumnRenamed("c_mktsegment", "segment")
    return access.filter_by_scope(customers, "segment", ANALYST, ENV, scope(spark)).select(
        "c_custkey", "c_name", "segment"
    )


def row_filter_by_name(spark: SparkSession, d: str) -> DataFrame:
    """The registered filter, found by the name a contract declares."""
    customers = table(spark, d, "customer").withColumnRenamed("c_mktsegment", "cost_centre")
    entitled = scope(spark).withColumnRenamed("segment", "cost_centre")
    parts = [
        access.apply_row_filter(
            customers, "security.filter_by_cost_centre", ["cost_centre"], caller, ENV, entitled
        ).withColumn("caller", F.lit(name))
        for name, caller in CALLERS.items()
    ]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("caller", "cost_centre")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def segment_policy(spark: SparkSession, d: str) -> DataFrame:
    mart = customer_360(spark, d)
    parts = {
        "full": access.segment_policy(mart, READER, None, {"grace"}),
        "own": access.segment_policy(mart, STRANGER, "FURNITURE", {"grace"}),
        "unset": access.segment_policy(mart, STRANGER, None, {"grace"}),
    }
    return reduce(
        DataFrame.unionByName,
        [df.select("customer_id", "segment").withColumn("who", F.lit(n)) for n, df in parts.items()],
    )


def grant_check(spark: SparkSession, d: str) -> DataFrame:
    return access.authorise(
        frame(spark, d, "requests"),
        frame(spark, d, "memberships"),
        grants(spark, EVENT_GRANTS),
    )


def access_review(spark: SparkSession, d: str) -> DataFrame:
    held = frame(spark, d, "grant_rows").select(
        "securable",
        "principal",
        F.when(F.col("may_modify"), F.array(F.lit("MODIFY"), F.lit("SELECT")))
        .otherwise(F.array(F.lit("SELECT")))
        .alias("privileges"),
    )
    return access.access_review(
        held, frame(spark, d, "contract_rows"), frame(spark, d, "principals")
    )


def dlp_redact(spark: SparkSession, d: str) -> DataFrame:
    return access.dlp_gate(customer_360(spark, d)).select(
        "customer_id", "email", "segment", "lifetime_value"
    )


def sample_lookup(spark: SparkSession, d: str) -> DataFrame:
    """`SELECT .. LIMIT 1` as an analyst: the usual look at whether a mask works."""
    one = access.sample_lookup(governed(spark, d, ANALYST), "email")
    return one.withColumn("caller", F.lit("analyst"))


QUERIES = {
    "governed_read": governed_read,
    "sample_lookup": sample_lookup,
    "governed_read_callers": governed_read_callers,
    "scope_seed": scope_seed,
    "governed_seed_read": governed_seed_read,
    "mask_pii": mask_pii,
    "apply_masks": apply_masks,
    "masked_view": masked_view,
    "sql_mask_function": sql_mask_function,
    "row_filter_scope": row_filter_scope,
    "row_filter_by_name": row_filter_by_name,
    "segment_policy": segment_policy,
    "grant_check": grant_check,
    "access_review": access_review,
    "dlp_redact": dlp_redact,
}

SQL = {
    "scope_seed": """SELECT c_name || '@corp.example' AS user_email, c_mktsegment AS cost_centre
        FROM customer""",
    "governed_seed_read": f"""WITH {C360}
        SELECT customer_id, 'REDACTED' AS email, segment, lifetime_value FROM c360
        WHERE segment LIKE 'M%'""",
    "governed_read": f"""WITH {C360}
        SELECT customer_id, 'REDACTED' AS email, segment, lifetime_value
        FROM c360 WHERE segment IN ('BUILDING', 'MACHINERY')""",
    "governed_read_callers": f"""WITH {C360}, seen AS (
        SELECT 'reader' AS caller, segment, email, lifetime_value FROM c360
        UNION ALL
        SELECT 'analyst', segment, 'REDACTED', lifetime_value
        FROM c360 WHERE segment IN ('BUILDING', 'MACHINERY'))
        SELECT caller, segment, COUNT(*) AS n_rows,
               COUNT(*) FILTER (WHERE email = 'REDACTED') AS n_redacted,
               CAST(SUM(lifetime_value) AS DECIMAL(18,2)) AS lifetime_value
        FROM seen GROUP BY caller, segment""",
    "sample_lookup": "SELECT 'REDACTED' AS email, 'analyst' AS caller FROM customer LIMIT 1",
    "mask_pii": "SELECT c_custkey, 'REDACTED' AS c_name, c_mktsegment FROM customer",
    "apply_masks": f"""WITH {C360}
        SELECT customer_id, 'REDACTED' AS email, segment, TRUE AS value_hidden FROM c360""",
    "masked_view": f"""WITH {C360}
        SELECT customer_id, email, segment, lifetime_value, 'grace' AS seen_by FROM c360
        UNION ALL
        SELECT customer_id, 'REDACTED', segment, lifetime_value, 'bob' FROM c360""",
    "sql_mask_function": """
        SELECT s_suppkey, 'REDACTED' AS hidden, s_name AS shown FROM supplier""",
    "row_filter_scope": """
        SELECT c_custkey, c_name, c_mktsegment AS segment
        FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "row_filter_by_name": """
        SELECT 'reader' AS caller, c_mktsegment AS cost_centre, COUNT(*) AS n_rows
        FROM customer GROUP BY c_mktsegment
        UNION ALL
        SELECT 'analyst', c_mktsegment, COUNT(*) FROM customer
        WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY c_mktsegment""",
    "segment_policy": """
        SELECT c_custkey AS customer_id, c_mktsegment AS segment, 'full' AS who FROM customer
        UNION ALL
        SELECT c_custkey, c_mktsegment, 'own' FROM customer WHERE c_mktsegment = 'FURNITURE'""",
    "grant_check": with_inputs("requests", "memberships")
    + """, held(securable, principal, privilege) AS (VALUES
            ('lake.silver', 'BUILDING', 'SELECT'), ('lake.silver.click', 'MACHINERY', 'SELECT'),
            ('lake.silver.click', 'MACHINERY', 'MODIFY'), ('lake', 'HOUSEHOLD', 'SELECT'),
            ('lake.silver.error', 'u7', 'MODIFY')),
        asked AS (SELECT "user", securable, privilege, COUNT(*) AS n_requests
                  FROM requests GROUP BY ALL)
        SELECT a."user", a.securable, a.privilege, a.n_requests,
               EXISTS (SELECT 1 FROM held h
                       WHERE h.privilege = a.privilege
                         AND (h.securable = a.securable
                              OR starts_with(a.securable, h.securable || '.'))
                         AND (h.principal = a."user" OR h.principal IN (
                              SELECT m."group" FROM memberships m WHERE m."user" = a."user")))
                   AS allowed
        FROM asked a""",
    "access_review": with_inputs("grant_rows", "contract_rows", "principals")
    + """, looked AS (
        SELECT securable, principal,
               CASE WHEN may_modify THEN 'MODIFY,SELECT' ELSE 'SELECT' END AS privileges,
               securable IN (SELECT model FROM contract_rows WHERE pii) AS on_pii,
               ('.' || securable || '.') LIKE '%.audit.%' AS on_audit,
               principal NOT IN (SELECT principal FROM principals) AS stale
        FROM grant_rows)
        SELECT * FROM looked WHERE on_pii OR on_audit OR stale""",
    "dlp_redact": f"""WITH {C360}
        SELECT customer_id, 'REDACTED' AS email, 'REDACTED' AS segment, lifetime_value
        FROM c360""",
}
