"""Data tests: not null, unique, range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column with its null count; all columns in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.isnull(c)).alias(f"null_{i}") for i, c in enumerate(cols)],
    )
    checks = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"null_{i}").alias("n_null"))
            for i, c in enumerate(cols)
        ]
    )
    return counts.select("n_rows", F.inline(checks)).select(
        "column", "n_rows", "n_null", (F.col("n_null") == 0).alias("passed")
    )


def check_unique(df: DataFrame, cols: list[str]) -> DataFrame:
    """The keys that occur more than once, with how often."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def check_range(df: DataFrame, col: str, low, high) -> DataFrame:
    """Count of values outside [low, high]; nulls are left to `check_not_null`."""
    outside = ~F.col(col).between(F.lit(low), F.lit(high))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(outside).alias("n_outside")
    ).select(
        F.lit(col).alias("column"),
        "n_rows",
        "n_outside",
        (F.col("n_outside") == 0).alias("passed"),
    )
