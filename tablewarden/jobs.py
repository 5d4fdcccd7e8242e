"""Pipeline units: a plain `run` that a scheduler or a thin notebook calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablewarden.context import Env
from tablewarden.operators.contract import apply_tags, enforce_contract
from tablewarden.operators.marts import build_customer_360
from tablewarden.sources.tables import read_table, shadow_name, shadow_write

CUSTOMER_360 = (
    T.StructType()
    .add("customer_id", "long")
    .add("email", "string")
    .add("segment", "string")
    .add("lifetime_value", T.DecimalType(18, 2))
)
TAGS = {
    "email": {
        "pii": True,
        "classification": "Restricted",
        "sensitivity": "Sensitive-High",
        "retention_days": 2555,
        "mask_function": "security.mask_pii",
    },
    "segment": {"pii": False, "classification": "Restricted", "no_mask_required": True},
    "lifetime_value": {"pii": False, "classification": "Official-Closed"},
}


def run(spark: SparkSession, source: Env, target: Env, name: str = "silver.customer_360") -> DataFrame:
    """Build the customer mart, hold it to its contract, tag it, and write it as the shadow table."""
    mart = build_customer_360(
        read_table(spark, source, "customer"), read_table(spark, source, "orders")
    )
    checked = enforce_contract(mart, CUSTOMER_360)
    shadow_write(apply_tags(checked, TAGS), target, name)
    return read_table(spark, target, shadow_name(name))
