"""Lineage look-ups, project declarations and change impact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.context import cut_lineage, lookup_join, small_or_shuffled
from tablewarden.functions.containment import contained_words
from tablewarden.functions.patterns import quote
from tablewarden.functions.text import (
    lines,
    package_name,
    path_segment,
    source_label,
    strip,
)
from tablewarden.sources.documents import parse_nodes, parse_readers

NOTHING = "—"

# Changes that touch everything.
GLOBAL_FILES = (
    "pyproject.toml",
    "uv.lock",
    "databricks.yml",
    "justfile",
    ".pre-commit-config.yaml",
)
GLOBAL_FOLDERS = (".github", "infra", "tools")
SCOPES = {"apps": "app", "libs": "lib", "dbt": "model_project"}


#: What a manifest says about a model, beside where it lies: relation and column.
ATTRIBUTES = {
    "project": "package_name",
    "access": "access",
    "materialized": "materialized",
    "contract_enforced": "contract_enforced",
    "classification": "classification",
    "pii": "pii",
}


def where_is(nodes: DataFrame, edges: DataFrame, name: str, strict: bool = False) -> DataFrame:
    """Where a model lives, what is said of it, what it reads and who reads it, one row per relation.

    `nodes(node_id, name, ..., depends_on)` with any of the columns of `ATTRIBUTES`,
    `edges(node_id, child_id)`. Rows instead of arrays keep a model with very many
    readers from filling one record. With `strict` an unknown name is an error.
    """
    hits = nodes.filter(F.col("name") == name)
    if strict and hits.isEmpty():
        raise LookupError(f"no model named {name!r}")
    about = hits.select("node_id", F.lit("located_at").alias("relation"), F.col("path").alias("other"))
    reads = hits.select(
        "node_id", F.lit("depends_on").alias("relation"), F.explode("depends_on").alias("other")
    )
    ids = hits.select("node_id").distinct()
    read_by = lookup_join(edges, ids, ["node_id"], "left_semi").select(
        "node_id", F.lit("consumed_by").alias("relation"), F.col("child_id").alias("other")
    )
    said = {relation: column for relation, column in ATTRIBUTES.items() if column in nodes.columns}
    if said:
        facts = F.array(*[F.struct(F.lit(r).alias("relation"), F.col(c).cast("string").alias("other"))
                          for r, c in said.items()])
        told = hits.select("node_id", F.inline(facts)).filter(F.col("other").isNotNull())
        about = about.unionByName(told)
    return about.unionByName(reads).unionByName(read_by).distinct()


def where_is_in_manifests(
    manifests: DataFrame, name: str, text: str = "text", file: str | None = None, strict: bool = False
) -> DataFrame:
    """`where_is` over manifest files; a node's readers are those that its own file names."""
    nodes = parse_nodes(manifests, text, file).filter(F.col("name") == name)
    # Few nodes have one name; their files and ids decide which readers are kept.
    at = cut_lineage(nodes)
    readers = lookup_join(
        parse_readers(manifests, text, file), at.select("file", "node_id").distinct(),
        ["file", "node_id"], "left_semi")
    return where_is(at, readers.select("node_id", "child_id"), name, strict)


def file_hits(paths: DataFrame, name: str) -> DataFrame:
    """(project, path) of model files called `<name>.sql` below a project's models folder."""
    pattern = rf"^dbt/([^/]+)/models/(?:.*/)?{quote(name)}\.sql$"
    path = F.col("path")
    hits = paths.filter(F.endswith(path, F.lit(f"/{name}.sql")) & path.rlike(pattern))
    return hits.select(F.regexp_extract(path, pattern, 1).alias("project"), "path").distinct()


def consumers_by_text(catalogue: DataFrame, name: str, text: str = "text", prefix: str = "apps/"):
    """Backquoted `apps/..` tokens on lines that mention the name."""
    mentioning = F.filter(
        lines(F.col(text)), lambda s: F.contains(s, F.lit(name)) & F.contains(s, F.lit(prefix))
    )
    tokens = F.flatten(F.transform(mentioning, lambda s: F.split(s, "`")))
    return catalogue.select(
        F.explode(F.filter(tokens, lambda t: F.startswith(t, F.lit(prefix)))).alias("consumer")
    ).distinct()


def expand_consumers(changed: DataFrame, declarations: DataFrame) -> DataFrame:
    """(lib, app) for every declaration text that contains a changed library's name."""
    return contained_words(
        declarations.select("app", "text"), "text", changed.select("lib"), "lib"
    ).distinct()


def affected(paths: DataFrame, declarations: DataFrame) -> DataFrame:
    """Scopes that changed paths touch: distinct (kind, name).

    `kind` is app, lib, model_project, or global with an empty name when
    something that concerns everything changed.
    """
    path = F.col("path")
    top, name = path_segment(path, 0), path_segment(path, 1)
    everywhere = path.isin(*GLOBAL_FILES) | top.isin(*GLOBAL_FOLDERS)
    kind = F.when(everywhere, F.lit("global"))
    for folder, label in SCOPES.items():
        kind = kind.when((top == folder) & name.isNotNull(), F.lit(label))
    direct = (
        paths.filter(path != "")
        .select(kind.alias("kind"), F.when(everywhere, F.lit("")).otherwise(name).alias("name"))
        .filter(F.col("kind").isNotNull())
        .distinct()
    )
    libs = direct.filter("kind = 'lib'").select(F.col("name").alias("lib"))
    consumers = expand_consumers(libs, declarations).select(
        F.lit("app").alias("kind"), F.col("app").alias("name")
    )
    return direct.unionByName(consumers).distinct()


def boundary_violations(edges: DataFrame, apps: DataFrame) -> DataFrame:
    """Imports by one app from another app's package. `edges(app, module)`, `apps(name)`."""
    owners = (
        apps.select(F.col("name").alias("foreign_app"))
        .distinct()
        .withColumn("package", package_name(F.col("foreign_app")))
    )
    imports = edges.withColumn("package", F.get(F.split("module", r"\."), F.lit(0)))
    return (
        imports.join(small_or_shuffled(cut_lineage(owners)), "package")
        .filter(F.col("app") != F.col("foreign_app"))
        .select("app", "module", "foreign_app")
    )


def _declared_sources(projects: DataFrame) -> DataFrame:
    """Distinct (consumer, producer) from the parentheses of each input."""
    return (
        projects.select(F.col("name").alias("consumer"), F.explode("inputs").alias("_input"))
        .select("consumer", source_label(F.col("_input")).alias("producer"))
        .filter("producer <> ''")
        .distinct()
    )


def external_sources(projects: DataFrame) -> DataFrame:
    """Named sources that are no project here."""
    sources = _declared_sources(projects).select("producer").distinct()
    names = projects.select(F.col("name").alias("producer")).distinct()
    return sources.join(names, "producer", "left_anti").withColumnRenamed("producer", "source")


def read_edges(projects: DataFrame) -> DataFrame:
    """The read matrix in long form: one row per consumer and internal producer it reads."""
    names = projects.select(F.col("name").alias("producer")).distinct()
    reads = _declared_sources(projects).join(names, "producer", "left_semi")
    return reads.select("consumer", "producer")


def read_matrix(projects: DataFrame, producers: list[str] | None = None) -> DataFrame:
    """Consumer rows by producer columns.

    Every project has a row. Without a second project or any internal read
    there is no matrix (no rows). A matrix has a column per producer, so it is
    only for a project list that fits a page; `read_edges` has no such limit.
    """
    spark = projects.sparkSession
    names = projects.select(F.col("name").alias("consumer")).distinct()
    if producers is None:
        widest = int(spark.conf.get("spark.sql.pivotMaxValues", "10000"))
        rows = names.orderBy("consumer").limit(widest + 1).collect()
        if len(rows) > widest:
            raise ValueError("too many producers for columns; use read_edges")
        producers = [r["consumer"] for r in rows]
    reads = read_edges(projects)
    flags = reads.groupBy("consumer").agg(
        *[F.bool_or(F.col("producer") == p).alias(p) for p in producers]
    )
    matrix = names.join(flags, "consumer", "left").select(
        "consumer", *[F.coalesce(F.col(f"`{p}`"), F.lit(False)).alias(p) for p in producers]
    )
    if len(producers) < 2 or reads.isEmpty():
        return matrix.filter(F.lit(False))
    return matrix


def project_catalogue(projects: DataFrame) -> DataFrame:
    """Arrays as text, a dash for what is empty; projects without a name are left out."""

    def listed(c: str) -> Column:
        return F.when(F.size(c) > 0, F.array_join(c, ", ")).otherwise(NOTHING)

    return projects.filter("name <> ''").select(
        "name",
        "folder",
        "owner",
        listed("inputs").alias("reads_from"),
        listed("outputs").alias("writes_to"),
        F.when(F.col("schedule") != "", F.col("schedule")).otherwise(NOTHING).alias("schedule"),
    )


def keyword_search(df: DataFrame, keyword: str, cols: list[str], array_cols: list[str] = ()):
    """Rows where a column or an array item contains the keyword, ignoring case."""
    needle = F.lit(keyword.lower())
    hits = [F.coalesce(F.contains(F.lower(c), needle), F.lit(False)) for c in cols]
    hits += [
        F.coalesce(F.exists(c, lambda item: F.contains(F.lower(item), needle)), F.lit(False))
        for c in array_cols
    ]
    return df.filter(reduce(lambda a, b: a | b, hits))


def _sections(text: Column) -> Column:
    """The `## ` sections of a text: array of (name in lower case, body lines).

    The text is cut in front of each heading line; a part's first line is its
    name. What precedes the first heading is no section.
    """
    parts = F.split(
        F.concat(F.lit("\n"), F.array_join(lines(text), "\n")), r"\n## (?=[^\n])", -1
    )
    bodies = F.transform(
        F.filter(parts, lambda part, i: i > 0), lambda part: F.split(part, "\n", -1)
    )
    return F.transform(
        bodies,
        lambda rows: F.struct(
            F.lower(strip(F.get(rows, F.lit(0)))).alias("name"),
            F.slice(rows, F.lit(2), F.size(rows)).alias("body"),
        ),
    )


def _bullets(sections: Column, name: str) -> Column:
    body = F.flatten(
        F.transform(F.filter(sections, lambda s: s["name"] == name), lambda s: s["body"])
    )
    marked = F.filter(
        F.transform(body, lambda b: strip(b)), lambda b: F.startswith(b, F.lit("- "))
    )
    entries = F.transform(marked, lambda b: strip(F.substr(b, F.lit(3))))
    return F.filter(entries, lambda e: (e != "") & ~F.startswith(e, F.lit("(")))


def _first_lines(sections: Column, name: str) -> Column:
    """The first non-empty line of every section called `name`."""
    firsts = F.transform(
        F.filter(sections, lambda s: s["name"] == name),
        lambda s: F.get(
            F.filter(F.transform(s["body"], lambda b: strip(b)), lambda b: b != ""), F.lit(0)
        ),
    )
    return F.array_compact(firsts)


def markdown_sections(df: DataFrame, text: str = "text") -> DataFrame:
    """Project declarations out of Markdown, one row per document and no shuffle.

    Adds name, owner, inputs, outputs, schedule. A bullet in parentheses and a
    schedule that starts with TODO are placeholders.
    """
    first = F.get(lines(F.col(text)), F.lit(0))
    cut = df.withColumn("_sections", _sections(F.col(text)))
    s = F.col("_sections")
    owners = _first_lines(s, "owner")
    schedules = F.filter(
        _first_lines(s, "schedule"), lambda v: ~F.startswith(v, F.lit("TODO"))
    )

    def last_or_blank(values: Column) -> Column:
        return F.coalesce(F.get(values, F.size(values) - 1), F.lit(""))

    return cut.withColumns(
        {
            "name": F.when(
                F.startswith(first, F.lit("# ")), strip(F.substr(first, F.lit(3)))
            ).otherwise(""),
            "owner": last_or_blank(owners),
            "inputs": _bullets(s, "inputs"),
            "outputs": _bullets(s, "outputs"),
            "schedule": last_or_blank(schedules),
        }
    ).drop("_sections", text)


def library_cards(df: DataFrame, text: str = "text", default_owner: str = "@platform-team"):
    """Library guides to owner, description, provides, consumers; one row per document.

    Lines count without the spaces around them, so a heading may be indented.
    """
    flush = F.array_join(F.transform(lines(F.col(text)), lambda s: strip(s)), "\n")
    df = df.withColumn(text, flush)
    cut = df.withColumn("_sections", _sections(F.col(text)))
    s = F.col("_sections")

    def body(name: str) -> Column:
        return F.transform(
            F.flatten(
                F.transform(F.filter(s, lambda x: x["name"] == name), lambda x: x["body"])
            ),
            lambda b: strip(b),
        )

    def bullets(name: str) -> Column:
        dashed = F.filter(body(name), lambda b: F.startswith(b, F.lit("-")))
        return F.transform(dashed, lambda b: strip(F.regexp_replace(b, "^[- ]+", "")))

    owners = F.filter(body("owner"), lambda b: F.startswith(b, F.lit("@")))
    lead = F.get(F.split(F.col(text), "\n## "), F.lit(0))
    paragraphs = F.filter(
        F.transform(F.split(lead, "\n\n"), lambda p: strip(p)),
        lambda p: (p != "") & ~F.startswith(p, F.lit("#")),
    )
    return cut.withColumns(
        {
            "owner": F.coalesce(F.get(owners, F.size(owners) - 1), F.lit(default_owner)),
            "description": F.coalesce(F.get(paragraphs, F.lit(0)), F.lit("")),
            "provides": bullets("provides"),
            "consumers": bullets("consumers"),
        }
    ).drop("_sections", text)
