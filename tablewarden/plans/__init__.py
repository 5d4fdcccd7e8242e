"""Registered queries: every operator over the given tables, with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

TOPICS = (
    "access",
    "contracts",
    "migration",
    "privacy",
    "deployments",
    "lineage",
    "ownership",
    "texts",
    "copies",
    "marts",
)


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for topic in TOPICS:
        found.update(import_module(f"tablewarden.plans.{topic}").QUERIES)
    return found


def all_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for topic in TOPICS:
        found.update(import_module(f"tablewarden.plans.{topic}").SQL)
    return found
