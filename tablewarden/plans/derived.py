"""Inputs the operators need, derived from the given tables.

Written once in SQL that Spark and DuckDB both read, so a query and its
counterpart start from the same rows. `{table}` names a given table or another
derived input. Nothing is filtered by id or cut short.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


_NAME = re.compile(r"\{(\w+)\}")

_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"

INPUTS = {
    # a migrated copy of orders with lost rows, shifted prices and new nulls
    "new_orders": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 400000
                    THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice,
               o_orderdate,
               CASE WHEN o_orderstatus = 'P' AND o_totalprice < 5000
                    THEN NULL ELSE o_orderpriority END AS o_orderpriority
        FROM {orders}
        WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 2500)""",
    # daily comparison results per table pair
    "daily_diff": """
        SELECT o_orderpriority AS pair, CAST(o_orderdate AS DATE) AS day,
               o_totalprice >= 10000 AS passed, o_totalprice < 6000 AS explained
        FROM {orders}""",
    "contract_rows": """
        SELECT p_brand || '_' || p_type AS model,
               'c' || p_partkey AS column_name,
               p_size <> 1 AS has_pii,
               p_size BETWEEN 20 AND 34 AS pii,
               CASE WHEN p_type = 'ECONOMY' THEN 'Official-Open'
                    WHEN p_type = 'STANDARD' THEN 'Official-Closed'
                    WHEN p_type = 'LARGE' THEN 'Restricted'
                    WHEN p_type = 'PROMO' THEN 'Confidential'
                    WHEN p_type = 'MEDIUM' AND p_size > 45 THEN 'Secret'
                    WHEN p_type = 'MEDIUM' THEN 'Restricted' END AS classification,
               p_size <> 2 AS has_sensitivity,
               CASE WHEN p_size = 2 THEN NULL
                    WHEN p_size < 20 THEN 'Sensitive-Normal'
                    WHEN p_size < 40 THEN 'Sensitive-High'
                    WHEN p_size < 49 THEN 'NA'
                    WHEN p_size = 50 THEN 'Unknown' END AS sensitivity,
               p_size <> 3 AS has_retention,
               CASE WHEN p_size <> 3 THEN (p_size - 5) * 30 END AS retention_days,
               p_name LIKE '%ring' OR p_name LIKE '%bolt' OR p_name LIKE 'cold%' AS has_mask,
               CASE WHEN p_name LIKE '%ring' OR p_name LIKE '%bolt'
                    THEN 'security.mask_pii' END AS mask_function,
               p_name LIKE 'hot%' AS no_mask_required
        FROM {part}""",
    "filtered_models": """
        SELECT DISTINCT p_brand || '_' || p_type AS model,
               p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#11', 'Brand#21') AS filtered
        FROM {part}""",
    # one grant per part; teams with an odd number no longer exist
    "grant_rows": """
        SELECT CASE WHEN p_name LIKE 'cold%' THEN 'lake.audit.' || p_brand
                    ELSE p_brand || '_' || p_type END AS securable,
               'team-' || p_size AS principal,
               p_size > 25 AS may_modify
        FROM {part}""",
    "principals": "SELECT DISTINCT 'team-' || (s_nationkey * 2) AS principal FROM {supplier}",
    "requests": """
        SELECT 'u' || user_id AS "user", 'lake.silver.' || event_type AS securable,
               CASE WHEN value > 100 THEN 'MODIFY' ELSE 'SELECT' END AS privilege
        FROM {events}""",
    "memberships": """
        SELECT 'u' || c_custkey AS "user", c_mktsegment AS "group" FROM {customer}""",
    "tickets": """
        SELECT 'T-' || c_custkey AS ticket, c_custkey AS subject_id
        FROM {customer} WHERE c_acctbal < -700""",
    # how long a case stayed open: ordered on one day, shipped on another
    "cases": """
        SELECT 'T-' || l_orderkey || '-' || l_linenumber AS ticket, l_suppkey AS subject_id,
               CAST(o_orderdate AS DATE) AS opened,
               CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS confirmed
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "storage_paths": """
        SELECT c_custkey AS id,
               's3://lake-' || lower(c_mktsegment) || '-' ||
               CASE r_name WHEN 'ASIA' THEN 'ap-southeast-1' WHEN 'EUROPE' THEN 'eu-west-1'
                           WHEN 'AMERICA' THEN 'us-east-2' WHEN 'AFRICA' THEN 'af-south-1'
                           ELSE 'me-central-1' END || '/raw then ap-southeast-1' AS path
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
                        JOIN {region} ON n_regionkey = r_regionkey""",
    "deploys": f"""
        SELECT event_id, ts, 'bundle-' || user_id AS bundle,
               CASE WHEN event_type IN ('click', 'view') THEN 'dev'
                    WHEN event_type = 'signup' THEN 'staging' ELSE 'prod' END AS target,
               md5('v' || CAST(floor(value / 20) AS BIGINT)) AS git_sha,
               'dev-' || CAST(floor({_K} / 10) AS BIGINT) AS author,
               CASE WHEN value > 300 THEN NULL
                    ELSE 'dev-' || CAST(({_K} % 10) AS BIGINT) END AS approver,
               CASE event_type WHEN 'signup' THEN 'CHG-' WHEN 'view' THEN ''
                               ELSE 'CHG-' || event_id END AS change_ticket
        FROM {{events}}""",
    "sites": """
        SELECT page_id, url, html,
               regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host,
               regexp_extract(url, '^[a-z]+://(blog|www|m)[.]', 1) AS kind,
               regexp_extract(url, '([a-z-]+)[.]example', 1) AS label,
               regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)', 1) AS lang
        FROM {pages}""",
    "folders": """
        SELECT page_id, lang,
               CASE lang WHEN 'en' THEN 'apps/' WHEN 'fr' THEN 'libs/' WHEN 'es' THEN 'dbt/'
                         ELSE 'infra/' END ||
               CASE kind WHEN 'blog' THEN 'finance-' WHEN 'www' THEN 'supplier-'
                         WHEN 'm' THEN 'infra-' ELSE '' END || label AS path
        FROM {sites}""",
    "changed_paths": """
        SELECT CASE lang WHEN 'en' THEN 'apps/' WHEN 'fr' THEN 'libs/' WHEN 'es' THEN 'dbt/'
                         ELSE 'infra/' END || label || '/src/job_' || page_id || '.py' AS path
        FROM {sites}""",
    "declarations": "SELECT label || '-' || lang AS app, url || ' ' || html AS text FROM {sites}",
    "rule_lines": """
        SELECT page_id AS ord,
               CASE lang WHEN 'de' THEN '# section ' || label
                         WHEN 'es' THEN '  /dbt/' || label || '/  '
                         ELSE ' /' || lang || '/' || label || '/*   @' || label || '-team  @' ||
                              lang || '-leads # since page ' || page_id END AS line
        FROM {sites}""",
    "imports": f"""
        SELECT event_id, 'svc-' || event_type AS app,
               CASE WHEN {_K} < 10 THEN 'svc_click' WHEN {_K} < 20 THEN 'svc_view.db'
                    WHEN {_K} < 30 THEN 'svc_signup.api.v1' WHEN {_K} < 40 THEN 'svc_error_log'
                    ELSE 'libs_common.io' END AS module
        FROM {{events}}""",
    "services": "SELECT DISTINCT 'svc-' || event_type AS name FROM {events}",
    "mails": """
        SELECT doc_id, '/' || CASE WHEN lang = 'en' THEN 'apps' ELSE 'docs' END || '/' || source ||
               '/' || doc_id || '.md' AS path, text
        FROM {documents}""",
    "guides": """
        SELECT doc_id,
               '# ' || source || chr(10) || 'Texts in ' || lang || '.' || chr(10) || chr(10) ||
               '## Owner' || chr(10) || chr(10) || ' @' || lang || '-team ' || chr(10) ||
               '## Inputs' || chr(10) || '- silver.' || lang || ' (' || source || ')' || chr(10) ||
               '  - raw.text' || chr(10) || '- (none yet)' || chr(10) ||
               '## Outputs' || chr(10) ||
               CASE WHEN lang = 'de' THEN '' ELSE '- gold.doc_' || doc_id || chr(10) END ||
               '## Provides' || chr(10) || '-- ' || source || ' reader' || chr(10) ||
               '## Schedule' || chr(10) ||
               CASE WHEN lang = 'fr' THEN 'TODO choose' ELSE 'daily ' || n_chars END || chr(10) ||
               '## Notes' || chr(10) || text AS text
        FROM {documents}""",
    "manifests": """
        SELECT '{"nodes": {"model.' || doc_id || '": {"name": "' || source || '", "package_name": "'
               || lang || '", "path": "models/' || doc_id || '.sql", "access": ' ||
               CASE WHEN n_chars > 1000 THEN '"public"' ELSE 'null' END ||
               ', "config": {"materialized": "table"' ||
               CASE WHEN lang = 'en' THEN ', "contract": {"enforced": true}' ELSE '' END ||
               '}, "meta": {"classification": "' || CASE WHEN lang = 'fr' THEN 'Restricted' ELSE 'Official-Open' END ||
               '", "pii": ' || CASE WHEN lang = 'fr' THEN 'true' ELSE 'false' END ||
               '}, "depends_on": {"nodes": ["source.' || lang || '", "source.' || source || '"]}}}' ||
               CASE WHEN lang = 'de' THEN '' ELSE
                    ', "child_map": {"model.' || doc_id || '": ["mart.' || source || '"]}' END ||
               CASE WHEN lang = 'es' THEN '' ELSE '}' END AS text
        FROM {documents}""",
    "jobs": """
        SELECT o_orderkey AS path,
               'resources:' || chr(10) || '  job_id: ' || o_orderkey || chr(10) ||
               '  catalog: ' || CASE o_orderstatus WHEN 'F' THEN 'lake_dev' WHEN 'O' THEN 'LAKE_PROD'
                                ELSE 'other' END || chr(10) ||
               '  notebook_path: /Workspace/Users/u' || o_custkey || '/load_' || o_orderkey ||
               CASE WHEN o_totalprice > 200000 THEN '.sql' ELSE '' END || chr(10) ||
               '  node_type_id: i3.xlarge' || chr(10) || '  num_workers: ' || o_custkey || chr(10) ||
               CASE WHEN o_orderpriority = '1-URGENT' THEN '  run_as: me' || chr(10) ELSE '' END ||
               CASE WHEN o_orderpriority = '5-LOW' THEN '  data: s3://old/' || o_orderkey ELSE '' END
               AS text
        FROM {orders}""",
    "projects": """
        SELECT 'svc-' || event_type AS name, 'apps/svc-' || event_type AS folder,
               'user-' || user_id AS owner,
               'silver.t' || CAST(floor(value) AS BIGINT) || ' (' ||
               CASE WHEN value > 250 THEN 'svc-click' WHEN value > 200 THEN 'svc-view'
                    WHEN value > 100 THEN 'crm-' || user_id WHEN value > 50 THEN 'erp' ELSE '' END
               || ')' AS input, value > 20 AS reads, value > 40 AS writes,
               CASE WHEN value > 60 THEN 'daily' ELSE '' END AS schedule, event_id
        FROM {events}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a derived input."""
    if name not in INPUTS:
        return table(spark, sf_dir, name)
    text = INPUTS[name]
    needed = sorted(set(_NAME.findall(text)))
    views = {}
    for other in needed:
        views[other] = f"_{other}"
        frame(spark, sf_dir, other).createOrReplaceTempView(views[other])
    text = text.replace('"user"', "`user`").replace('"group"', "`group`")
    return spark.sql(_NAME.sub(lambda m: views[m.group(1)], text))


def with_inputs(*names: str) -> str:
    """`WITH a AS (..), b AS (..)` for the SQL side, in order of need."""
    ordered: list[str] = []

    def need(name: str) -> None:
        if name in INPUTS and name not in ordered:
            for other in _NAME.findall(INPUTS[name]):
                need(other)
            ordered.append(name)

    for name in names:
        need(name)
    return "WITH " + ",\n".join(
        f"{n} AS ({_NAME.sub(lambda m: m.group(1), INPUTS[n])})" for n in ordered
    )
