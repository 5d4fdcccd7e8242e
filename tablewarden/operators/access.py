"""Caller-dependent reads: grants, then row filter, then column masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.context import Caller, Env, cut_lineage, lookup_join, small_or_shuffled
from tablewarden.functions.masks import MASKS, REDACTED, ROW_FILTERS, Mask, mask_pii, scope_filter


class ExportBlocked(PermissionError):
    """An export would carry columns that must not leave."""


def apply_masks(
    df: DataFrame, caller: Caller, env: Env, registry: dict[str, Mask] | None = None
) -> DataFrame:
    """Mask every column whose tags name a mask function; other columns pass through."""
    masks = MASKS if registry is None else registry
    columns = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        name = f.metadata.get("mask_function")
        if name:
            col = masks[name](col, caller, env, f.dataType)
        columns.append(col.alias(f.name, metadata=f.metadata))
    return df.select(*columns)


def masked_view(
    df: DataFrame,
    clear: list[str],
    masked: list[str],
    readers: set[str],
    caller: Caller,
    view: str | None = None,
) -> DataFrame:
    """A projection that shows `masked` columns to the named users only, dropping no row."""
    allowed = F.lit(caller.user in readers)
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = [
        F.col(c)
        if c in clear
        else F.when(allowed, F.col(c))
        .otherwise(
            F.lit(REDACTED)
            if types[c].simpleString() == "string"
            else F.lit(None).cast(types[c])
        )
        .alias(c)
        for c in df.columns
        if c in clear or c in masked
    ]
    out = df.select(*columns)
    if view:
        out.createOrReplaceTempView(view)
    return out


def _restrict(df: DataFrame, rule: Column | DataFrame, column: str) -> DataFrame:
    if isinstance(rule, DataFrame):
        return lookup_join(df, rule, [column], "left_semi")
    return df.filter(rule)


def filter_by_scope(
    df: DataFrame,
    column: str,
    caller: Caller,
    env: Env,
    scope: DataFrame,
    team: str = "finance_team",
) -> DataFrame:
    """Rows whose `column` lies in the caller's scope; no row for unknown callers.

    A short scope is inlined as an `IN` list, which reaches the Parquet scan.
    """
    return _restrict(df, scope_filter(caller, env, scope, column, team), column)


def apply_row_filter(
    df: DataFrame, name: str, on_columns: list[str], caller: Caller, env: Env, scope: DataFrame
) -> DataFrame:
    """The registered row filter `name` on each of its columns."""
    for column in on_columns:
        df = _restrict(df, ROW_FILTERS[name](caller, env, scope, column), column)
    return df


def segment_policy(
    df: DataFrame,
    caller: Caller,
    setting: str | None,
    full_access: set[str],
    column: str = "segment",
) -> DataFrame:
    """Full-access users see all rows, others their segment; an unset segment sees none."""
    if caller.user in full_access:
        return df
    if setting is None:
        return df.filter(F.lit(False))
    return df.filter(F.col(column) == setting)


def _enclosing(securable: Column) -> Column:
    """A dotted name and the names that contain it, widest first."""
    parts = F.split(securable, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), ".")
    )


def has_privilege(grants: DataFrame, caller: Caller, securable: str, privilege: str) -> bool:
    """Whether the caller or one of their groups holds the privilege, here or on a container."""
    parts = securable.split(".")
    names = [".".join(parts[: i + 1]) for i in range(len(parts))]
    held = grants.filter(
        F.col("securable").isin(*names)
        & F.col("principal").isin(caller.user, *sorted(caller.groups))
        & F.array_contains("privileges", privilege)
    )
    return not held.isEmpty()


def require_privilege(grants: DataFrame, caller: Caller, securable: str, privilege: str) -> None:
    if not has_privilege(grants, caller, securable, privilege):
        raise PermissionError(f"{caller.user} lacks {privilege} on {securable}")


def authorise(requests: DataFrame, memberships: DataFrame, grants: DataFrame) -> DataFrame:
    """Decide many requests at once.

    `requests(user, securable, privilege)`, `memberships(user, group)`,
    `grants(securable, principal, privileges)`. Repeats are counted before any
    join, so a user who sends most of the requests weighs no more than another.
    """
    asked = requests.groupBy("user", "securable", "privilege").agg(
        F.count(F.lit(1)).alias("n_requests")
    )
    held = cut_lineage(
        grants.select(
            F.col("securable").alias("container"),
            "principal",
            F.explode("privileges").alias("privilege"),
        ).distinct()
    )
    granted = small_or_shuffled(held.select("principal").distinct())
    # Only principals that hold anything matter.
    principals = (
        memberships.select("user", F.col("group").alias("principal"))
        .unionByName(asked.select("user", F.col("user").alias("principal")))
        .join(granted, "principal", "left_semi")
        .distinct()
    )
    # Containers first: a request meets the grants of its own containers, never all
    # groups of its user.
    allowed = (
        asked.select("user", "securable", "privilege")
        .withColumn("container", F.explode(_enclosing(F.col("securable"))))
        .join(small_or_shuffled(held), ["container", "privilege"])
        .select("user", "securable", "privilege", "principal")
        .distinct()
        .join(principals, ["user", "principal"], "left_semi")
        .select("user", "securable", "privilege")
        .distinct()
        .withColumn("allowed", F.lit(True))
    )
    return asked.join(allowed, ["user", "securable", "privilege"], "left").withColumn(
        "allowed", F.coalesce("allowed", F.lit(False))
    )


def governed_read(
    df: DataFrame,
    securable: str,
    caller: Caller,
    env: Env,
    grants: DataFrame,
    scope: DataFrame,
    row_filter: tuple[str, list[str]] | None = None,
) -> DataFrame:
    """Grants, then the row filter on raw values, then masks."""
    require_privilege(grants, caller, securable, "SELECT")
    if row_filter:
        df = apply_row_filter(df, row_filter[0], row_filter[1], caller, env, scope)
    return apply_masks(df, caller, env)


def sample_lookup(df: DataFrame, *columns: str) -> DataFrame:
    """One row of some columns, to see what a caller gets shown."""
    return df.select(*columns).limit(1)


def dlp_gate(df: DataFrame, mode: str = "redact", levels=("Restricted", "Confidential")) -> DataFrame:
    """Redact columns tagged with one of `levels` before export, or refuse the export."""
    tagged = [f.name for f in df.schema.fields if f.metadata.get("classification") in levels]
    if mode == "block":
        if tagged:
            raise ExportBlocked(f"columns {tagged} must not be exported")
        return df
    if mode != "redact":
        raise ValueError(f"unknown mode {mode!r}")
    nobody = Caller("")
    return df.select(
        *[
            mask_pii(F.col(f.name), nobody, Env("prod"), f.dataType).alias(
                f.name, metadata=f.metadata
            )
            if f.name in tagged
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def access_review(grants: DataFrame, contract: DataFrame, principals: DataFrame) -> DataFrame:
    """Grants to look at again: on a table with PII, in an `audit` schema, or to nobody.

    `contract.model` and `grants.securable` share one naming; `principals(principal)`.
    """
    pii_tables = (
        contract.filter(F.coalesce("pii", F.lit(False)))
        .select(F.col("model").alias("securable"))
        .distinct()
        .withColumn("_pii", F.lit(True))
    )
    alive = principals.select("principal").distinct().withColumn("_alive", F.lit(True))
    marked = lookup_join(grants, pii_tables, ["securable"], "left")
    reviewed = lookup_join(marked, alive, ["principal"], "left").select(
        "securable",
        "principal",
        F.array_join(F.array_sort("privileges"), ",").alias("privileges"),
        F.coalesce("_pii", F.lit(False)).alias("on_pii"),
        F.col("securable").rlike(r"(^|\.)audit(\.|$)").alias("on_audit"),
        F.isnull("_alive").alias("stale"),
    )
    return reviewed.filter("on_pii OR on_audit OR stale")
