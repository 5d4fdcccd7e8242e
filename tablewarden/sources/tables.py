"""Tables, scope seeds, shadow copies and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.context import Env
from tablewarden.operators.audit import AUDIT_SCHEMA

SCOPE_SCHEMA = "user_email string, cost_centre string"


def read_table(spark: SparkSession, env: Env, name: str) -> DataFrame:
    return spark.read.parquet(env.path(name))


def read_scope(spark: SparkSession, path: str) -> DataFrame:
    """The scope seed: CSV with a header, `user_email,cost_centre`."""
    return spark.read.schema(SCOPE_SCHEMA).csv(path, header=True)


def shadow_name(name: str) -> str:
    return f"{name}_v2"


def shadow_write(df: DataFrame, env: Env, name: str) -> str:
    """Write next to the legacy table and leave that one alone; returns the path."""
    path = env.path(shadow_name(name))
    df.write.mode("overwrite").parquet(path)
    return path


def append_audit(df: DataFrame, path: str) -> None:
    """Append-only JSON below target/date (in UTC). Records carry every audit field.

    Rebalanced by folder: few files each, and a busy day is split over tasks.
    """
    records = df.select(*[F.col(f.name).cast(f.dataType) for f in AUDIT_SCHEMA.fields])
    dated = records.withColumn("date", F.to_date(F.to_utc_timestamp("ts", F.current_timezone())))
    dated.hint("rebalance", F.col("target"), F.col("date")).write.mode("append").partitionBy(
        "target", "date"
    ).json(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    schema = "ts timestamp, bundle string, git_sha string, actor string, ci_job_url string, " \
        "ci_pipeline_id string, mr_iid string, change_ticket string, target string, date date"
    return spark.read.schema(schema).json(path)


def in_order(df: DataFrame, *by: str) -> DataFrame:
    """Rows sorted by `by`, then by the other sortable columns, so a report repeats exactly.

    The sort is a range partitioning: part files follow one another in order.
    """
    sortable = [
        f.name
        for f in df.schema.fields
        if f.name not in by and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    return df.orderBy(*by, *sortable)


def dump_csv(df: DataFrame, out: str, date: str, name: str, *by: str) -> str:
    """`<out>/<date>/<name>.csv`, a folder of sorted part files with a header each."""
    path = f"{out}/{date}/{name}.csv"
    in_order(df, *by).write.mode("overwrite").csv(path, header=True)
    return path


def report_json(df: DataFrame, *by: str) -> DataFrame:
    """Each row as one JSON text, in order; nulls are kept."""
    return in_order(df, *by).select(
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json")
    )
