"""Text corpora, model manifests and exported contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.functions.text import strip
from tablewarden.operators.contract import COLUMNS_SCHEMA

CONTRACT_FILE = (
    "models array<struct<name: string, columns: array<struct<name: string, data_type: string, "
    "meta: variant>>, "
    "config: struct<contract: struct<enforced: boolean>, "
    "row_filter: struct<function: string, on_columns: array<string>>>>>"
)


def read_corpus(spark: SparkSession, globs: list[str], exclude: list[str] = ()) -> DataFrame:
    """(path, text), one row per file. `exclude` are path endings. Unreadable files are skipped."""
    files = (
        spark.read.option("ignoreCorruptFiles", "true")
        .option("ignoreMissingFiles", "true")
        .text(list(globs), wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )
    for ending in exclude:
        files = files.filter(~F.endswith("path", F.lit(ending)))
    return files


def _named(text: str, file: str | None) -> Column:
    """What tells files apart: their name, or else what is in them."""
    return (F.col(file) if file else F.sha2(F.col(text), 256)).alias("file")


def _entries(df: DataFrame, text: str, file: str | None, part: str) -> DataFrame:
    """(file, key, value) of one object of every manifest, one row an entry."""
    tvf = df.sparkSession.tvf
    objects = df.select(
        _named(text, file), F.try_variant_get(F.try_parse_json(text), f"$.{part}", "variant").alias("_part")
    ).filter(F.col("_part").isNotNull())
    entries = objects.lateralJoin(tvf.variant_explode(F.col("_part").outer()))
    return entries.filter(F.col("key").isNotNull()).select("file", "key", "value")


def parse_nodes(df: DataFrame, text: str = "text", file: str | None = None) -> DataFrame:
    """One row per node of every manifest; a manifest that does not parse gives nothing."""

    def value(path: str, kind: str) -> Column:
        return F.try_variant_get("value", f"$.{path}", kind)

    reads = value("depends_on.nodes", "array<string>")
    return _entries(df, text, file, "nodes").select(
        "file",
        F.col("key").alias("node_id"),
        value("name", "string").alias("name"),
        value("package_name", "string").alias("package_name"),
        value("path", "string").alias("path"),
        value("access", "string").alias("access"),
        value("config.materialized", "string").alias("materialized"),
        value("config.contract.enforced", "boolean").alias("contract_enforced"),
        value("meta.classification", "string").alias("classification"),
        value("meta.pii", "boolean").alias("pii"),
        F.coalesce(reads, F.array().cast("array<string>")).alias("depends_on"),
    )


def parse_readers(df: DataFrame, text: str = "text", file: str | None = None) -> DataFrame:
    """(file, node_id, child_id): who reads a node, out of every manifest's `child_map`."""
    children = F.try_variant_get("value", "$", "array<string>")
    return _entries(df, text, file, "child_map").select(
        "file", F.col("key").alias("node_id"), F.explode(children).alias("child_id")
    ).distinct()


def parse_manifests(df: DataFrame, text: str = "text", file: str | None = None) -> DataFrame:
    """The nodes with their readers as `consumed_by`. Nodes and readers are parsed apart and
    joined by file and node, so that no row holds a whole `child_map`."""
    readers = _entries(df, text, file, "child_map").select(
        "file", F.col("key").alias("node_id"),
        F.try_variant_get("value", "$", "array<string>").alias("consumed_by"),
    ).dropDuplicates(["file", "node_id"])
    none = F.array().cast("array<string>")
    return parse_nodes(df, text, file).join(readers, ["file", "node_id"], "left").withColumn(
        "consumed_by", F.coalesce("consumed_by", none)
    ).drop("file")


def manifest_nodes(spark: SparkSession, globs: list[str]) -> DataFrame:
    return parse_manifests(read_corpus(spark, globs), file="path")


def manifest_edges(nodes: DataFrame) -> DataFrame:
    """(node_id, child_id) out of the nodes' readers."""
    return nodes.select("node_id", F.explode("consumed_by").alias("child_id"))


def contract_errors(df: DataFrame, text: str = "text", file: str = "path") -> DataFrame:
    """(file, model, column, position, violation): one row for each file that does not parse.

    A file that was read as null counts too; a blank one declares nothing and is no error.
    """
    body = F.col(text)
    broken = F.isnull(body) | ((strip(body) != "") & F.isnull(F.try_parse_json(body)))
    none = F.lit(None).cast("string")
    return df.filter(broken).select(
        F.col(file).alias("file"), none.alias("model"), none.alias("column"),
        F.lit(0).alias("position"), F.lit("cannot parse").alias("violation"),
    )


def contract_table(df: DataFrame, text: str = "text", file: str | None = None) -> DataFrame:
    """Exported contracts (JSON, one file per row) to one row per model and column.

    Tags are read as variants, which tell a missing key from a null, and a
    number from a text that looks like one. With `file`, the column that names the file,
    rows carry it, and equal model names of different files stay apart. Files that do not
    parse have no row here but one in `contract_errors`.
    """
    carried = [F.col(file).alias("file")] if file else []
    models = df.select(*carried, F.from_json(F.col(text), CONTRACT_FILE).alias("f")).select(
        *(["file"] if file else []), F.explode("f.models").alias("m")
    )
    columns = models.select(
        *(["file"] if file else []), F.col("m.name").alias("model"), F.explode("m.columns").alias("c"))
    meta = F.col("c.meta")

    def declared(key: str) -> Column:
        return F.variant_get(meta, f"$.{key}", "variant").isNotNull()

    def value(key: str, kind: str) -> Column:
        return F.try_variant_get(meta, f"$.{key}", kind)

    def kind_of(key: str) -> Column:
        return F.schema_of_variant(F.variant_get(meta, f"$.{key}", "variant"))

    waived = (
        F.when(kind_of("no_mask_required") == "BOOLEAN", value("no_mask_required", "boolean"))
        .when(kind_of("no_mask_required") == "STRING", value("no_mask_required", "string") != "")
        .otherwise(F.coalesce(value("no_mask_required", "double") != 0, F.lit(False)))
    )
    return columns.select(
        *(["file"] if file else []),
        "model",
        F.col("c.name").alias("column"),
        F.col("c.data_type").alias("data_type"),
        declared("pii").alias("has_pii"),
        value("pii", "boolean").alias("pii"),
        value("classification", "string").alias("classification"),
        declared("sensitivity").alias("has_sensitivity"),
        value("sensitivity", "string").alias("sensitivity"),
        declared("retention_days").alias("has_retention"),
        F.when(kind_of("retention_days") == "BIGINT", value("retention_days", "int")).alias(
            "retention_days"
        ),
        declared("mask_function").alias("has_mask"),
        value("mask_function", "string").alias("mask_function"),
        waived.alias("no_mask_required"),
    )


def contract_models(df: DataFrame, text: str = "text", file: str | None = None) -> DataFrame:
    carried = [F.col(file).alias("file")] if file else []
    return df.select(*carried, F.from_json(F.col(text), CONTRACT_FILE).alias("f")).select(
        *(["file"] if file else []), F.explode("f.models").alias("m")
    ).select(
        *(["file"] if file else []),
        F.col("m.name").alias("model"),
        F.col("m.config.contract.enforced").alias("contract_enforced"),
        F.col("m.config.row_filter").alias("row_filter"),
    )


def contract_from_schema(df: DataFrame, model: str) -> DataFrame:
    """The tags on a frame's own fields as contract rows."""
    rows = [
        (
            model,
            f.name,
            f.dataType.simpleString(),
            "pii" in f.metadata,
            f.metadata.get("pii"),
            f.metadata.get("classification"),
            "sensitivity" in f.metadata,
            f.metadata.get("sensitivity"),
            "retention_days" in f.metadata,
            f.metadata.get("retention_days"),
            "mask_function" in f.metadata,
            f.metadata.get("mask_function"),
            f.metadata.get("no_mask_required", False),
        )
        for f in df.schema.fields
    ]
    return df.sparkSession.createDataFrame(rows, COLUMNS_SCHEMA)
