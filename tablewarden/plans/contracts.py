"""Contract lint, inventories and data tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.vocabulary import CLASSIFICATIONS, in_vocabulary
from tablewarden.context import Caller, Env
from tablewarden.jobs import TAGS
from tablewarden.operators import contract, quality
from tablewarden.operators.access import apply_masks
from tablewarden.plans.derived import frame, table, with_inputs
from tablewarden.sources.documents import contract_errors, contract_from_schema, contract_table
from tablewarden.sources.tables import report_json


def rows(spark: SparkSession, d: str) -> DataFrame:
    return frame(spark, d, "contract_rows").withColumnRenamed("column_name", "column")


def models(spark: SparkSession, d: str) -> DataFrame:
    declared = F.struct(
        F.lit("security.filter_by_cost_centre").alias("function"),
        F.array(F.lit("cost_centre"), F.lit("region")).alias("on_columns"),
    )
    return frame(spark, d, "filtered_models").select(
        "model", F.when(F.col("filtered"), declared).alias("row_filter")
    )


def contract_violations(spark, d):
    found = contract.contract_violations(rows(spark, d))
    return found.withColumn("position", F.col("position").cast("bigint"))


def contract_warnings(spark, d):
    return contract.contract_warnings(rows(spark, d), models(spark, d))


def contract_source(spark, d):
    """Contracts written out as JSON files' text, some of them broken off; read back and checked."""
    r = rows(spark, d)

    def entry(key: str, shown) -> Column:
        """`"key": value` as JSON text; a null value stays in."""
        return F.concat(F.lit(f'"{key}": '), F.coalesce(shown, F.lit("null")))

    def quoted(name: str) -> Column:
        return F.concat(F.lit('"'), F.col(name), F.lit('"'))

    tags = F.array_compact(
        F.array(
            F.when(F.col("has_pii"), entry("pii", F.col("pii").cast("string"))),
            entry("classification", quoted("classification")),
            F.when(F.col("has_sensitivity"), entry("sensitivity", quoted("sensitivity"))),
            F.when(
                F.col("has_retention"), entry("retention_days", F.col("retention_days").cast("string"))
            ),
            F.when(F.col("has_mask"), entry("mask_function", quoted("mask_function"))),
            entry("no_mask_required", F.col("no_mask_required").cast("string")),
        )
    )
    texts = r.select(
        F.concat(
            F.lit('{"models": [{"name": "'), "model", F.lit('", "columns": [{"name": "'), "column",
            F.lit('", "meta": {'), F.array_join(tags, ", "), F.lit("}}]}]}"),
        ).alias("text"),
        F.concat(F.lit("contracts/"), "column", F.lit(".json")).alias("path"),
        F.col("mask_function").isNotNull().alias("masked"),
    )
    # For each contract with a mask there is a second file, the first half of it.
    broken = texts.filter("masked").select(
        F.expr("left(text, length(text) div 2)").alias("text"),
        F.concat(F.lit("half/"), "path").alias("path"), "masked")
    files = texts.unionByName(broken)
    found = contract.contract_violations(contract_table(files, file="path"))
    found = found.unionByName(contract_errors(files))
    by_folder = F.split_part("file", F.lit("/"), F.lit(1)).alias("folder")
    return found.groupBy(by_folder, "violation").agg(F.count(F.lit(1)).alias("n"))


def derived_tags(spark, d):
    """A mart whose columns are computed: each takes the strictest tags of its inputs, and is
    masked by them for a caller outside the readers."""
    customers = contract.apply_tags(table(spark, d, "customer"), {
        "c_name": TAGS["email"], "c_mktsegment": TAGS["segment"]})
    orders = contract.apply_tags(table(spark, d, "orders"), {
        "o_totalprice": TAGS["lifetime_value"], "o_orderstatus": {"classification": "Official-Open"}})
    mart = customers.join(orders, customers.c_custkey == orders.o_custkey).groupBy(
        F.concat_ws("/", "c_mktsegment", "o_orderstatus").alias("cell")
    ).agg(
        F.max("c_name").alias("last_name"),
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("amount"),
    )
    tagged = contract.derive_tags(mart, [customers, orders], {
        "cell": ["c_mktsegment", "o_orderstatus"], "last_name": ["c_name"],
        "n_orders": ["o_orderstatus"], "amount": ["o_totalprice"]})
    seen = apply_masks(tagged, Caller("bob"), Env("prod"))
    said = contract_from_schema(tagged, "mart").select("column", "classification", "mask_function")
    labels = said.agg(F.array_join(F.array_sort(F.collect_list(
        F.concat_ws(":", "column", "classification", "mask_function"))), ";").alias("tags"))
    return seen.join(F.broadcast(labels))


def list_masks(spark, d):
    return contract.list_masks(rows(spark, d))


def list_row_filters(spark, d):
    return contract.list_row_filters(models(spark, d))


def mask_coverage(spark, d):
    """Synced: the filtered models. Masked views: the columns with a mask."""
    r = rows(spark, d)
    synced = models(spark, d).filter("row_filter IS NOT NULL")
    return contract.mask_coverage(r, synced, r.filter("mask_function IS NOT NULL"))


def vocabulary(spark, d):
    return rows(spark, d).select(
        "model",
        "column",
        in_vocabulary(F.col("classification"), CLASSIFICATIONS).alias("known"),
    )


ORDERS = (
    T.StructType()
    .add("o_custkey", "long")
    .add("o_orderkey", "long")
    .add("o_orderstatus", "string")
    .add("o_totalprice", T.DecimalType(18, 2))
)


def enforce_contract(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        "o_orderstatus",
    )
    return contract.enforce_contract(orders, ORDERS)


def check_not_null(spark, d):
    return quality.check_not_null(
        frame(spark, d, "new_orders"), ["o_orderkey", "o_custkey", "o_orderpriority"]
    )


def check_unique(spark, d):
    return quality.check_unique(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def check_range(spark, d):
    customers = quality.check_range(table(spark, d, "customer"), "c_acctbal", 0.0, 9000.0)
    return customers.unionByName(
        quality.check_range(table(spark, d, "lineitem"), "l_discount", 0.0, 0.1)
    )


def report(spark, d):
    findings = contract.contract_warnings(rows(spark, d), models(spark, d))
    return report_json(findings.select("model", "n_columns"))


QUERIES = {
    "contract_violations": contract_violations,
    "contract_warnings": contract_warnings,
    "contract_source": contract_source,
    "derived_tags": derived_tags,
    "list_masks": list_masks,
    "list_row_filters": list_row_filters,
    "mask_coverage": mask_coverage,
    "vocabulary": vocabulary,
    "enforce_contract": enforce_contract,
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_range": check_range,
    "report_json": report,
}

_FOUND = """found AS (
    SELECT model, column_name, 1 AS rule, 'missing pii' AS violation
    FROM contract_rows WHERE NOT has_pii
    UNION ALL
    SELECT model, column_name, 2, CASE WHEN classification IS NULL
        THEN 'missing classification' ELSE 'invalid classification' END
    FROM contract_rows WHERE classification IS NULL OR classification NOT IN
        ('Official-Open', 'Official-Closed', 'Restricted', 'Confidential')
    UNION ALL
    SELECT model, column_name, 3, CASE WHEN NOT has_sensitivity
        THEN 'missing sensitivity' ELSE 'invalid sensitivity' END
    FROM contract_rows WHERE NOT has_sensitivity OR sensitivity IS NULL
        OR sensitivity NOT IN ('Sensitive-Normal', 'Sensitive-High', 'NA')
    UNION ALL
    SELECT model, column_name, 4, CASE WHEN NOT has_retention
        THEN 'missing retention_days' ELSE 'retention_days must be a positive integer' END
    FROM contract_rows WHERE NOT has_retention OR retention_days IS NULL OR retention_days <= 0
    UNION ALL
    SELECT model, column_name, 5, 'missing mask_function'
    FROM contract_rows WHERE classification IN ('Restricted', 'Confidential')
        AND NOT has_mask AND NOT no_mask_required)"""
_WARNED = """warned AS (
    SELECT model, COUNT(*) AS n_columns FROM contract_rows
    WHERE classification IN ('Restricted', 'Confidential')
      AND model NOT IN (SELECT model FROM filtered_models WHERE filtered)
    GROUP BY model)"""

SQL = {
    "contract_violations": f"""{with_inputs("contract_rows")}, {_FOUND}
        SELECT model, column_name AS "column", violation,
               ROW_NUMBER() OVER (PARTITION BY model, column_name ORDER BY rule) - 1 AS position
        FROM found""",
    "contract_warnings": f"""{with_inputs("contract_rows", "filtered_models")}, {_WARNED}
        SELECT model, n_columns FROM warned""",
    "contract_source": f"""{with_inputs("contract_rows")}, {_FOUND}
        SELECT 'contracts' AS folder, violation, COUNT(*) AS n FROM found GROUP BY violation
        UNION ALL SELECT 'half', 'cannot parse', COUNT(*) FROM contract_rows
        WHERE mask_function IS NOT NULL HAVING COUNT(*) > 0""",
    "derived_tags": """
        SELECT c_mktsegment || '/' || o_orderstatus AS cell, 'REDACTED' AS last_name,
               COUNT(*) AS n_orders,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount,
               'amount:Official-Closed;cell:Restricted;last_name:Restricted:security.mask_pii;'
               || 'n_orders:Official-Open' AS tags
        FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_mktsegment, o_orderstatus""",
    "list_masks": with_inputs("contract_rows")
    + """ SELECT model, column_name AS "column", mask_function
        FROM contract_rows WHERE mask_function IS NOT NULL""",
    "list_row_filters": with_inputs("filtered_models")
    + """ SELECT model, 'security.filter_by_cost_centre' AS function,
                 'cost_centre, region' AS on_columns
        FROM filtered_models WHERE filtered""",
    "mask_coverage": with_inputs("contract_rows", "filtered_models")
    + """ SELECT c.model, c.column_name AS "column"
        FROM contract_rows c JOIN filtered_models f ON f.model = c.model
        WHERE f.filtered AND c.pii AND NOT c.no_mask_required AND c.mask_function IS NULL""",
    "vocabulary": with_inputs("contract_rows")
    + """ SELECT model, column_name AS "column",
               COALESCE(classification IN
                   ('Official-Open', 'Official-Closed', 'Restricted', 'Confidential'), FALSE)
                   AS known
        FROM contract_rows""",
    "enforce_contract": """
        SELECT o_custkey, o_orderkey, o_orderstatus,
               CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice FROM orders""",
    "check_not_null": with_inputs("new_orders")
    + """ SELECT name AS "column", n_rows, n_null, n_null = 0 AS passed FROM (
            SELECT 'o_orderkey' AS name, COUNT(*) AS n_rows,
                   COUNT(*) - COUNT(o_orderkey) AS n_null FROM new_orders
            UNION ALL SELECT 'o_custkey', COUNT(*), COUNT(*) - COUNT(o_custkey) FROM new_orders
            UNION ALL SELECT 'o_orderpriority', COUNT(*), COUNT(*) - COUNT(o_orderpriority)
            FROM new_orders)""",
    "check_unique": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "check_range": """
        SELECT name AS "column", n_rows, n_outside, n_outside = 0 AS passed FROM (
            SELECT 'c_acctbal' AS name, COUNT(*) AS n_rows,
                   COUNT(*) FILTER (WHERE c_acctbal < 0 OR c_acctbal > 9000) AS n_outside
            FROM customer
            UNION ALL
            SELECT 'l_discount', COUNT(*),
                   COUNT(*) FILTER (WHERE l_discount < 0 OR l_discount > 0.1::DOUBLE)
            FROM lineitem)""",
    "report_json": f"""{with_inputs("contract_rows", "filtered_models")}, {_WARNED}
        SELECT '{{"model":"' || model || '","n_columns":' || n_columns || '}}' AS json
        FROM warned""",
}
