"""Mart tables from joined inputs. Facts are summed before they meet dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.operators.reconcile import MONEY


def build_customer_360(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """customer_id, email, segment, lifetime_value; customers without orders have 0.

    Orders are summed per customer first, with partial sums on the map side, so
    one customer with very many orders does not weigh on the join.
    """
    spent = orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.sum(F.col("o_totalprice").cast(MONEY)).alias("lifetime_value")
    )
    return (
        customer.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("email"),
            F.col("c_mktsegment").alias("segment"),
        )
        .join(spent, "customer_id", "left")
        .withColumn("lifetime_value", F.coalesce("lifetime_value", F.lit(0)).cast(MONEY))
    )


def budget_variance(actuals: DataFrame, budget: DataFrame) -> DataFrame:
    """actual - budget per cost centre and period; either side may lack a pair.

    `actuals(cost_centre, period, amount)`, `budget(cost_centre, period, amount)`.
    """

    def total(df: DataFrame, actual: bool) -> DataFrame:
        amount, nothing = F.col("amount").cast(MONEY), F.lit(0).cast(MONEY)
        return df.select(
            "cost_centre",
            "period",
            (amount if actual else nothing).alias("actual_amount"),
            (nothing if actual else amount).alias("budget_amount"),
        )

    return (
        total(actuals, True)
        .unionByName(total(budget, False))
        .groupBy("cost_centre", "period")
        .agg(
            F.sum("actual_amount").cast(MONEY).alias("actual_amount"),
            F.sum("budget_amount").cast(MONEY).alias("budget_amount"),
        )
        .withColumn("variance", (F.col("actual_amount") - F.col("budget_amount")).cast(MONEY))
    )
