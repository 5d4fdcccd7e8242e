"""Mart tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden import jobs
from tablewarden.context import Env, shared_dir
from tablewarden.operators import marts
from tablewarden.plans.access import C360
from tablewarden.plans.derived import table


def customer_360(spark, d):
    return marts.build_customer_360(table(spark, d, "customer"), table(spark, d, "orders"))


def budget_variance(spark, d):
    """Shipped value against ordered value, by priority and month."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    # Joined first: items are exchanged once, and sums by month are partial on the spot.
    items = table(spark, d, "lineitem").select(
        "l_orderkey",
        F.date_format("l_shipdate", "yyyy-MM").alias("period"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
    )
    actuals = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderpriority").alias("cost_centre"), "period", "amount"
    )
    budget = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("cost_centre"),
        F.date_format("o_orderdate", "yyyy-MM").alias("period"),
        F.col("o_totalprice").alias("amount"),
    )
    return marts.budget_variance(actuals, budget)


def nightly_run(spark, d):
    """The pipeline unit: reads one environment, writes the tagged shadow table of another."""
    written = jobs.run(spark, Env("prod", base=d), Env("dev", base=shared_dir(spark)))
    masked = [f.name for f in written.schema.fields if f.metadata.get("mask_function")]
    return written.withColumn("masked_columns", F.lit(",".join(masked)))


QUERIES = {
    "customer_360": customer_360,
    "nightly_run": nightly_run,
    "budget_variance": budget_variance,
}

SQL = {
    "customer_360": f"WITH {C360} SELECT * FROM c360",
    "nightly_run": f"WITH {C360} SELECT *, 'email' AS masked_columns FROM c360",
    "budget_variance": """WITH entries AS (
            SELECT o_orderpriority AS cost_centre, strftime(l_shipdate, '%Y-%m') AS period,
                   CAST(l_extendedprice AS DECIMAL(18,2)) AS actual,
                   CAST(0 AS DECIMAL(18,2)) AS budget
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            UNION ALL
            SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m'), 0,
                   CAST(o_totalprice AS DECIMAL(18,2)) FROM orders)
        SELECT cost_centre, period, CAST(SUM(actual) AS DECIMAL(18,2)) AS actual_amount,
               CAST(SUM(budget) AS DECIMAL(18,2)) AS budget_amount,
               CAST(SUM(actual) - SUM(budget) AS DECIMAL(18,2)) AS variance
        FROM entries GROUP BY cost_centre, period""",
}
