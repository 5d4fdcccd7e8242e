"""Orders against their migrated copy."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.context import Env, shared_dir
from tablewarden.operators import reconcile as r
from tablewarden.plans.derived import frame, table, with_inputs
from tablewarden.sources.tables import read_table, shadow_name, shadow_write

KEY = ["o_orderkey"]


def sides(spark, d):
    return table(spark, d, "orders"), frame(spark, d, "new_orders")


def recon_row_count(spark, d):
    return r.check_row_count(*sides(spark, d))


def recon_key_hash(spark, d):
    return r.check_key_hash(*sides(spark, d), KEY)


def recon_key_hist(spark, d):
    return r.key_hash_histogram(*sides(spark, d), KEY, 64)


def recon_null_rates(spark, d):
    return r.check_null_rates(*sides(spark, d))


def recon_metrics(spark, d):
    return r.check_metrics(*sides(spark, d), ["o_totalprice"])


def recon_checks(spark, d):
    return r.reconcile(*sides(spark, d), KEY, ["o_totalprice"])


def recon_verdict(spark, d):
    return r.verdict(recon_checks(spark, d))


def recon_duplicates(spark, d):
    """Lineitem's nominal key repeats; orders' does not."""
    items = table(spark, d, "lineitem")
    kept = items.filter("l_linestatus = 'F'")
    return r.duplicate_keys(items, kept, ["l_orderkey", "l_linenumber"])


def diff_rows(spark, d):
    return r.diff_rows(*sides(spark, d), KEY)


def diff_rows_repeated(spark, d):
    """A key that is not unique: repeated keys are reported, not multiplied."""
    items = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    moved = items.filter("l_quantity > 2 OR l_returnflag <> 'R'")
    return r.diff_rows(items, moved, ["l_orderkey", "l_linenumber"])


def diff_columns(spark, d):
    """A migrated copy with a column added, one dropped and one retyped; retyped values as text."""
    old = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    new = frame(spark, d, "new_orders").select(
        "o_orderkey", F.col("o_custkey").cast("string"), "o_orderpriority", F.lit(1).alias("o_batch"))
    return r.diff_rows(old, new, KEY)


def cutover_ready(spark, d):
    return r.cutover_ready(frame(spark, d, "daily_diff"), by=("pair",))


def cutover_ready_fast(spark, d):
    """The three-day exception for high-frequency jobs, all pairs together."""
    return r.cutover_ready(frame(spark, d, "daily_diff"), min_days=3)


def shadow(spark, d):
    """The migrated copy written beside the original and read back."""
    env = Env("dev", base=shared_dir(spark))
    shadow_write(frame(spark, d, "new_orders"), env, "silver.orders")
    return read_table(spark, env, shadow_name("silver.orders")).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


QUERIES = {
    "recon_row_count": recon_row_count,
    "recon_key_hash": recon_key_hash,
    "recon_key_hist": recon_key_hist,
    "recon_null_rates": recon_null_rates,
    "recon_metrics": recon_metrics,
    "recon_checks": recon_checks,
    "recon_verdict": recon_verdict,
    "recon_duplicates": recon_duplicates,
    "diff_rows": diff_rows,
    "diff_rows_repeated": diff_rows_repeated,
    "diff_columns": diff_columns,
    "cutover_ready": cutover_ready,
    "cutover_ready_fast": cutover_ready_fast,
    "shadow_write": shadow,
}

_N = "DECIMAL(38,6)"


def _relative(a: str, b: str) -> str:
    return (
        f"CASE WHEN CAST({a} AS DOUBLE) = CAST({b} AS DOUBLE) THEN 0.0::DOUBLE "
        f"WHEN {a} = 0 THEN 1.0::DOUBLE "
        f"ELSE abs(CAST({b} AS DOUBLE) - CAST({a} AS DOUBLE)) / abs(CAST({a} AS DOUBLE)) END"
    )


def _line(check: str, item: str, a: str, b: str, delta: str, passed: str, source: str) -> str:
    return (
        f"SELECT '{check}' AS check_name, '{item}' AS item, CAST({a} AS {_N}) AS legacy, "
        f"CAST({b} AS {_N}) AS new, round({delta}, 6) AS delta, {passed} AS passed FROM {source}"
    )


_HASH = "CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT)"
_COLUMNS = (
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderdate",
    "o_orderpriority",
)
_COUNTS = """counts AS (SELECT (SELECT COUNT(*) FROM orders) AS a,
                              (SELECT COUNT(*) FROM new_orders) AS b)"""
_HASHES = f"""hashes AS (SELECT (SELECT SUM({_HASH}) FROM orders) AS a,
                               (SELECT SUM({_HASH}) FROM new_orders) AS b,
                               (SELECT COUNT(*) FROM orders) AS na,
                               (SELECT COUNT(*) FROM new_orders) AS nb)"""
_SUMS = """sums AS (
    SELECT (SELECT SUM(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders) AS a,
           (SELECT SUM(CAST(o_totalprice AS DECIMAL(18,2))) FROM new_orders) AS b),
    means AS (
    SELECT (SELECT round(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
                         / COUNT(o_totalprice), 6) FROM orders) AS a,
           (SELECT round(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
                         / COUNT(o_totalprice), 6) FROM new_orders) AS b)"""


def _rates() -> str:
    parts = [
        f"SELECT '{c}' AS item, (SELECT COUNT(*) - COUNT({c}) FROM orders)"
        " / (SELECT COUNT(*) FROM orders)::DOUBLE AS a,"
        f" (SELECT COUNT(*) - COUNT({c}) FROM new_orders)"
        " / (SELECT COUNT(*) FROM new_orders)::DOUBLE AS b"
        for c in _COLUMNS
    ]
    return "rates AS (" + " UNION ALL ".join(parts) + ")"


_ROW_COUNT = _line(
    "row_count", "rows", "a", "b", _relative("a", "b"), f"{_relative('a', 'b')} <= 0.001", "counts"
)
_KEY_HASH = _line(
    "key_hash",
    "o_orderkey",
    "a",
    "b",
    "CASE WHEN a = b AND na = nb THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END",
    "a = b AND na = nb",
    "hashes",
)
_NULL_RATES = (
    f"SELECT 'null_rate' AS check_name, item, CAST(round(a, 6) AS {_N}) AS legacy, "
    f"CAST(round(b, 6) AS {_N}) AS new, round(abs(b - a), 6) AS delta, "
    "abs(b - a) <= 0.001 AS passed FROM rates"
)
_METRICS = " UNION ALL ".join(
    _line(
        f"metric_{kind}",
        "o_totalprice",
        "a",
        "b",
        _relative("a", "b"),
        f"{_relative('a', 'b')} <= 0.001",
        source,
    )
    for kind, source in (("sum", "sums"), ("avg", "means"))
)
_SCHEMA = " UNION ALL ".join(
    f"SELECT 'schema' AS check_name, '{c}' AS item, CAST(NULL AS {_N}) AS legacy, "
    f"CAST(NULL AS {_N}) AS new, 0.0::DOUBLE AS delta, TRUE AS passed"
    for c in _COLUMNS
)
_KEYS = " UNION ALL ".join(
    _line(check, "o_orderkey", "a", "b", "CAST(greatest(a, b) AS DOUBLE)", "greatest(a, b) = 0", f"""(
        SELECT (SELECT {what.format('orders')}) AS a, (SELECT {what.format('new_orders')}) AS b)""")
    for check, what in (
        ("key_not_null", "COUNT(*) - COUNT(o_orderkey) FROM {}"),
        (
            "key_unique",
            "COUNT(*) FROM (SELECT o_orderkey FROM {} GROUP BY o_orderkey HAVING COUNT(*) > 1)",
        ),
    )
)
_HIST = _line("key_hist", "o_orderkey", "a", "b", "CAST(unequal AS DOUBLE)", "unequal = 0", f"""(
    SELECT COUNT(*) FILTER (WHERE l > 0) AS a, COUNT(*) FILTER (WHERE n > 0) AS b,
           COUNT(*) FILTER (WHERE l <> n) AS unequal
    FROM (SELECT bucket, SUM(l) AS l, SUM(n) AS n
          FROM (SELECT {_HASH} % 64 AS bucket, 1 AS l, 0 AS n FROM orders
                UNION ALL SELECT {_HASH} % 64, 0, 1 FROM new_orders) GROUP BY bucket))""")
_INPUTS = with_inputs("new_orders")
_CHECKS = f"""checks AS ({_SCHEMA} UNION ALL {_ROW_COUNT} UNION ALL {_KEY_HASH}
    UNION ALL {_NULL_RATES} UNION ALL {_METRICS} UNION ALL {_KEYS} UNION ALL {_HIST})"""
_ISLANDS = """
    SELECT {by} MIN(day) AS first_day, MAX(day) AS last_day, COUNT(*) AS n_days,
           COUNT(*) >= {days} AS ready
    FROM (SELECT {by} day, day - CAST(ROW_NUMBER() OVER ({part} ORDER BY day) AS INT) AS run
          FROM (SELECT {by} day FROM daily_diff GROUP BY {by} day
                HAVING bool_and(passed OR explained)))
    GROUP BY {by} run"""

SQL = {
    "recon_row_count": f"{_INPUTS}, {_COUNTS} {_ROW_COUNT}",
    "recon_key_hash": f"{_INPUTS}, {_HASHES} {_KEY_HASH}",
    "recon_key_hist": f"""{_INPUTS}, tagged AS (
        SELECT {_HASH} % 64 AS bucket, 1 AS l, 0 AS n FROM orders
        UNION ALL SELECT {_HASH} % 64, 0, 1 FROM new_orders)
        SELECT bucket, CAST(SUM(l) AS BIGINT) AS n_legacy, CAST(SUM(n) AS BIGINT) AS n_new,
               SUM(l) = SUM(n) AS passed FROM tagged GROUP BY bucket""",
    "recon_null_rates": f"{_INPUTS}, {_rates()} {_NULL_RATES}",
    "recon_metrics": f"{_INPUTS}, {_SUMS} {_METRICS}",
    "recon_checks": f"{_INPUTS}, {_COUNTS}, {_HASHES}, {_rates()}, {_SUMS}, {_CHECKS} "
    "SELECT * FROM checks",
    "recon_verdict": f"{_INPUTS}, {_COUNTS}, {_HASHES}, {_rates()}, {_SUMS}, {_CHECKS} "
    "SELECT COUNT(*) AS n_checks, COUNT(*) FILTER (WHERE NOT passed) AS n_failed, "
    "bool_and(passed) AS passed FROM checks",
    "recon_duplicates": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS n_legacy,
               COUNT(*) FILTER (WHERE l_linestatus = 'F') AS n_new
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "diff_rows": f"""{_INPUTS}
        SELECT COALESCE(o.o_orderkey, n.o_orderkey) AS o_orderkey,
               CASE WHEN n.o_orderkey IS NULL THEN 'only_legacy'
                    WHEN o.o_orderkey IS NULL THEN 'only_new' ELSE 'changed' END AS status,
               CASE WHEN n.o_orderkey IS NULL OR o.o_orderkey IS NULL THEN ''
                    ELSE concat_ws(',',
                      CASE WHEN o.o_custkey IS DISTINCT FROM n.o_custkey THEN 'o_custkey' END,
                      CASE WHEN o.o_orderdate IS DISTINCT FROM n.o_orderdate THEN 'o_orderdate' END,
                      CASE WHEN o.o_orderpriority IS DISTINCT FROM n.o_orderpriority
                           THEN 'o_orderpriority' END,
                      CASE WHEN o.o_orderstatus IS DISTINCT FROM n.o_orderstatus
                           THEN 'o_orderstatus' END,
                      CASE WHEN o.o_totalprice IS DISTINCT FROM n.o_totalprice
                           THEN 'o_totalprice' END) END AS columns,
               CAST(o.o_orderkey IS NOT NULL AS BIGINT) AS n_legacy,
               CAST(n.o_orderkey IS NOT NULL AS BIGINT) AS n_new
        FROM orders o FULL JOIN new_orders n ON o.o_orderkey = n.o_orderkey
        WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL
           OR o.o_custkey IS DISTINCT FROM n.o_custkey
           OR o.o_orderdate IS DISTINCT FROM n.o_orderdate
           OR o.o_orderpriority IS DISTINCT FROM n.o_orderpriority
           OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus
           OR o.o_totalprice IS DISTINCT FROM n.o_totalprice""",
    "diff_rows_repeated": """WITH per_key AS (
            SELECT l_orderkey, l_linenumber, COUNT(*) AS n_legacy,
                   COUNT(*) FILTER (WHERE l_quantity > 2 OR l_returnflag <> 'R') AS n_new
            FROM lineitem GROUP BY l_orderkey, l_linenumber)
        SELECT l_orderkey, l_linenumber,
               CASE WHEN n_legacy > 1 THEN 'bad_key' ELSE 'only_legacy' END AS status,
               '' AS columns, n_legacy, n_new
        FROM per_key WHERE n_legacy > 1 OR n_new = 0""",
    "diff_columns": f"""{_INPUTS}
        SELECT COALESCE(o.o_orderkey, n.o_orderkey) AS o_orderkey,
               CASE WHEN n.o_orderkey IS NULL THEN 'only_legacy' ELSE 'changed' END AS status,
               CASE WHEN n.o_orderkey IS NULL THEN '' ELSE 'o_orderpriority' END AS columns,
               CAST(1 AS BIGINT) AS n_legacy, CAST(n.o_orderkey IS NOT NULL AS BIGINT) AS n_new
        FROM orders o LEFT JOIN new_orders n ON o.o_orderkey = n.o_orderkey
        WHERE n.o_orderkey IS NULL OR o.o_orderpriority IS DISTINCT FROM n.o_orderpriority
        UNION ALL SELECT NULL, status, columns, 0, 0
        FROM (VALUES ('column_added', 'o_batch'), ('column_dropped', 'o_orderstatus'),
                     ('column_retyped', 'o_custkey')) AS c(status, columns)""",
    "cutover_ready": with_inputs("daily_diff")
    + _ISLANDS.format(by="pair,", days=7, part="PARTITION BY pair"),
    "cutover_ready_fast": with_inputs("daily_diff") + _ISLANDS.format(by="", days=3, part=""),
    "shadow_write": f"{_INPUTS} SELECT o_orderkey, o_custkey, o_totalprice FROM new_orders",
}
