"""Column contracts: tags on schema fields, and checks over contract tables.

A contract table has one row per model and column. `has_<key>` says whether the
key was declared at all, since a key declared as null is not a missing key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.context import lookup_join
from tablewarden.functions.vocabulary import (
    CLASSIFICATIONS,
    NEEDS_MASK,
    SENSITIVITIES,
    in_vocabulary,
    strictest,
)

COLUMNS_SCHEMA = (
    "model string, column string, data_type string, has_pii boolean, pii boolean, "
    "classification string, has_sensitivity boolean, sensitivity string, "
    "has_retention boolean, retention_days int, has_mask boolean, mask_function string, "
    "no_mask_required boolean"
)
MODELS_SCHEMA = (
    "model string, contract_enforced boolean, "
    "row_filter struct<function: string, on_columns: array<string>>"
)
TAG_KEYS = (
    "pii",
    "classification",
    "sensitivity",
    "retention_days",
    "mask_function",
    "no_mask_required",
    "pii_class",
    "purpose",
)


class ContractError(ValueError):
    """A frame does not match what its contract declares."""


def apply_tags(df: DataFrame, contract: dict[str, dict]) -> DataFrame:
    """Attach each column's declared tags to its schema field."""
    unknown = sorted(set(contract) - set(df.columns))
    if unknown:
        raise ContractError(f"contract names columns the frame lacks: {unknown}")
    for name, tags in contract.items():
        stray = sorted(set(tags) - set(TAG_KEYS))
        if stray:
            raise ContractError(f"column {name}: unknown tags {stray}")
        df = df.withMetadata(name, {**df.schema[name].metadata, **tags})
    return df


def derive_tags(
    out: DataFrame, sources: list[DataFrame], mapping: dict[str, list[str]]
) -> DataFrame:
    """Tag computed columns from their inputs, taking the strictest of each tag.

    Spark drops field metadata on expressions and aggregates, so the inputs of
    each output column are named explicitly.
    """
    known: dict[str, dict] = {}
    for frame in sources:
        for f in frame.schema.fields:
            known.setdefault(f.name, {}).update(f.metadata)
    for name, inputs in mapping.items():
        tags = [known[c] for c in inputs]
        merged: dict = {}
        if any("pii" in t for t in tags):
            merged["pii"] = any(t.get("pii", False) for t in tags)
        level = strictest([t.get("classification") for t in tags], CLASSIFICATIONS)
        if level:
            merged["classification"] = level
        sensitivity = strictest([t.get("sensitivity") for t in tags], SENSITIVITIES)
        if sensitivity:
            merged["sensitivity"] = sensitivity
        days = [t["retention_days"] for t in tags if t.get("retention_days")]
        if days:
            merged["retention_days"] = min(days)
        ranked = sorted(
            (t for t in tags if t.get("mask_function")),
            key=lambda t: CLASSIFICATIONS.index(t.get("classification", CLASSIFICATIONS[0])),
        )
        if ranked:
            merged["mask_function"] = ranked[-1]["mask_function"]
        elif level in NEEDS_MASK and all(
            t.get("no_mask_required") for t in tags if t.get("classification") in NEEDS_MASK
        ):
            merged["no_mask_required"] = True
        out = out.withMetadata(name, merged)
    return out


def enforce_contract(df: DataFrame, declared: T.StructType) -> DataFrame:
    """The frame in declared column order; refused when names or types differ."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in declared.fields}
    problems = [f"missing column {n}" for n in wanted if n not in actual]
    problems += [f"undeclared column {n}" for n in actual if n not in wanted]
    problems += [
        f"column {n} is {actual[n].simpleString()}, declared {t.simpleString()}"
        for n, t in wanted.items()
        if n in actual and actual[n] != t
    ]
    if problems:
        raise ContractError("; ".join(problems))
    return df.to(declared)


def _violations(c) -> Column:
    """Broken rules of one column in report order, as an array."""
    label = c("classification")
    class_known = in_vocabulary(label, CLASSIFICATIONS)
    must_mask = in_vocabulary(label, NEEDS_MASK)
    waived = F.coalesce(c("no_mask_required"), F.lit(False))
    days_ok = F.coalesce(c("retention_days") > 0, F.lit(False))
    return F.array_compact(
        F.array(
            F.when(~c("has_pii"), F.lit("missing pii")),
            F.when(label.isNull(), F.lit("missing classification")).when(
                ~class_known, F.lit("invalid classification")
            ),
            F.when(~c("has_sensitivity"), F.lit("missing sensitivity")).when(
                ~in_vocabulary(c("sensitivity"), SENSITIVITIES), F.lit("invalid sensitivity")
            ),
            F.when(~c("has_retention"), F.lit("missing retention_days")).when(
                ~days_ok, F.lit("retention_days must be a positive integer")
            ),
            F.when(must_mask & ~c("has_mask") & ~waived, F.lit("missing mask_function")),
        )
    )


def contract_violations(contract: DataFrame) -> DataFrame:
    """One row per broken rule, numbered in report order, with the file if rows carry it. Map-only."""
    return contract.select(
        *_file_of(contract),
        F.coalesce("model", F.lit("<unnamed>")).alias("model"),
        F.coalesce("column", F.lit("<unnamed>")).alias("column"),
        F.posexplode(_violations(F.col)).alias("position", "violation"),
    )


def _file_of(df: DataFrame) -> list[str]:
    return ["file"] if "file" in df.columns else []


def _has_filter() -> Column:
    """A row filter that names neither a function nor columns is none."""
    declared = F.col("row_filter")
    named = declared.getField("function")
    columns = declared.getField("on_columns")
    return F.coalesce(named != "", F.lit(False)) | F.coalesce(F.size(columns) > 0, F.lit(False))


def contract_warnings(contract: DataFrame, models: DataFrame) -> DataFrame:
    """Models that hold a column in need of masking but declare no row filter.

    Models of different files are told apart where both frames carry the file.
    """
    keys = [*(_file_of(contract) and _file_of(models)), "model"]
    sensitive = (
        contract.filter(in_vocabulary(F.col("classification"), NEEDS_MASK))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_columns"))
    )
    filtered = models.filter(_has_filter()).select(*keys)
    return sensitive.join(filtered, keys, "left_anti")


def list_masks(contract: DataFrame) -> DataFrame:
    return contract.filter(F.col("mask_function").isNotNull()).select(
        "model", "column", "mask_function"
    )


def list_row_filters(models: DataFrame) -> DataFrame:
    return models.filter(_has_filter()).select(
        "model",
        F.col("row_filter.function").alias("function"),
        F.array_join("row_filter.on_columns", ", ").alias("on_columns"),
    )


def mask_coverage(contract: DataFrame, synced: DataFrame, masked_views: DataFrame) -> DataFrame:
    """PII columns of synced tables with neither a masked view nor a waiver.

    `synced(model)`; `masked_views(model, column)`.
    """
    exposed = contract.filter(
        F.coalesce("pii", F.lit(False)) & ~F.coalesce("no_mask_required", F.lit(False))
    ).select("model", "column")
    copied = lookup_join(exposed, synced.select("model").distinct(), ["model"], "left_semi")
    return copied.join(
        masked_views.select("model", "column").distinct(), ["model", "column"], "left_anti"
    )
