"""Text corpus jobs. All are row-local: whole texts in, rows or flags out, no shuffle."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.patterns import quote
from tablewarden.functions.text import lines, strip

# Lint limits, phrases and path schemes.
MAX_LINES = 200
REQUIRED_ANY = ("rules", "public api")
FORBIDDEN = ("databricks bundle deploy", "uv run pytest", "sbt clean")
ALLOW_MARKERS = ("make ", "<!-- raw-ok -->")
PATH_SCHEMES = ("dbfs:/", "s3://", "abfss://", "/Workspace/Users/")
WORKSPACE_FIELDS = ("job_id", "creator_user_name", "created_time", "run_as_user_name")
NOTEBOOK_PATH = r"notebook_path:\s*(/Workspace/[^\s]+)"
NOTEBOOK_SUFFIXES = ("py", "ipynb", "sql", "r", "scala")

# How private keys begin.
SECRET_PATTERNS = {"private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY( BLOCK)?-----"}


@dataclass(frozen=True)
class LintRules:
    max_lines: int = MAX_LINES
    required_any: tuple[str, ...] = REQUIRED_ANY
    # path regex -> `## ` headings such a document must have, in lower case
    required_sections: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {r"/apps/[^/]+/[^/]+\.md$": ("inputs", "outputs")}
    )


def lint_documents(df: DataFrame, rules: LintRules = LintRules(), path="path", text="text"):
    """One row per broken rule: no_heading, too_long, no_required_phrase, no_section:<name>."""
    df = df.withColumns({"_lines": lines(F.col(text)), "_lower": F.lower(text)})
    rows = F.col("_lines")
    heading = F.coalesce(F.startswith(F.get(rows, F.lit(0)), F.lit("# ")), F.lit(False))
    phrase = F.lit(False)
    for p in rules.required_any:
        phrase = phrase | F.contains("_lower", F.lit(p))
    found = [
        F.when(~heading, F.lit("no_heading")),
        F.when(F.size(rows) > rules.max_lines, F.lit("too_long")),
        F.when(~phrase, F.lit("no_required_phrase")),
    ]
    df = df.withColumn(
        "_headings",
        F.transform(
            F.filter(
                F.split("_lower", "\n"),
                lambda s: F.startswith(s, F.lit("## ")) & (F.length(s) > 3),
            ),
            lambda s: strip(F.substr(s, F.lit(4))),
        ),
    )
    for pattern, names in rules.required_sections.items():
        for name in names:
            found.append(
                F.when(
                    F.col(path).cast("string").rlike(pattern) & ~F.array_contains("_headings", name),
                    F.lit(f"no_section:{name}"),
                )
            )
    return df.select(F.col(path), F.explode(F.array_compact(F.array(*found))).alias("rule"))


def forbidden_lines(
    df: DataFrame, phrases=FORBIDDEN, allow=ALLOW_MARKERS, path: str = "path", text: str = "text"
) -> DataFrame:
    """(path, line_no, phrase) for each forbidden phrase on a line without an allow marker."""
    numbered = F.transform(
        lines(F.col(text)), lambda s, i: F.struct((i + 1).alias("line_no"), s.alias("line"))
    )

    def bad(entry) -> Column:
        hit, excused = F.lit(False), F.lit(False)
        for p in phrases:
            hit = hit | F.contains(entry["line"], F.lit(p))
        for a in allow:
            excused = excused | F.contains(entry["line"], F.lit(a))
        return hit & ~excused

    listed = F.array(*[F.lit(p) for p in phrases])
    return (
        df.select(F.col(path), F.explode(F.filter(numbered, bad)).alias("_e"))
        .select(path, F.col("_e.line_no").alias("line_no"), F.col("_e.line").alias("_line"))
        .select(
            path,
            "line_no",
            F.explode(F.filter(listed, lambda p: F.contains(F.col("_line"), p))).alias("phrase"),
        )
    )


def hardcoded_paths(df: DataFrame, text: str = "text", schemes=PATH_SCHEMES, path: str = "path"):
    """(path, scheme) for each scheme a text contains."""
    listed = F.array(*[F.lit(s) for s in schemes])
    return df.select(
        F.col(path),
        F.explode(F.filter(listed, lambda s: F.contains(F.col(text), s))).alias("scheme"),
    )


@dataclass(frozen=True)
class Rewrite:
    """Replace `pattern`; raise `flag` on texts that match `when` (default: the pattern).

    Every match contains `token`, so texts without it skip the regex.
    """

    token: str
    pattern: str
    replacement: str
    flag: str | None = None
    when: str | None = None


# The fields, patterns and replacements below.
def job_rewrites(catalogs: tuple[str, ...]) -> list[Rewrite]:
    """Make an exported job definition portable; `catalogs` are the environment catalogs."""
    suffix = "|".join(NOTEBOOK_SUFFIXES)
    names = "|".join(quote(c) for c in catalogs)
    notebook = r"notebook_path:\s*/Workspace/(?:[^\s/]*/)*"
    return [
        *[Rewrite(f"{f}:", rf"(?dm)^\s*{f}:.*$\n?", "") for f in WORKSPACE_FIELDS],
        Rewrite(":", rf"(?i)(catalog:\s*)(?:{names})", "$1\\${var.catalog}", "catalog"),
        Rewrite(
            "notebook_path:",
            notebook + rf"([^\s/]+\.(?:{suffix}))(\s|$)",
            "notebook_path: ./notebooks/$1$2",
            "notebook_path",
            when=NOTEBOOK_PATH,
        ),
        Rewrite(
            "/Workspace/", notebook + r"([^\s/]+)/*", "notebook_path: ./notebooks/$1.py"
        ),
        Rewrite(
            "node_type_id:",
            r"(node_type_id:\s*)\S+",
            "$1\\${var.cluster_node_type_id}",
            "node_type_id",
            when=r"node_type_id:\s*\w+",
        ),
        Rewrite(
            "num_workers:",
            r"(num_workers:\s*)\d+",
            "$1\\${var.cluster_num_workers}",
            "num_workers",
        ),
    ]


def rewrite_refs(
    df: DataFrame,
    rules: list[Rewrite],
    text: str = "text",
    required: dict[str, str] | None = None,
    schemes=PATH_SCHEMES,
    collect: dict[str, str] | None = None,
) -> DataFrame:
    """Apply the rewrites in order; adds `rewritten` and `flags`.

    `collect` maps a new column to a regex whose first group is gathered from
    the text as it was, such as the notebooks still to be fetched.

    `required` maps token -> flag raised when the rewritten text lacks it. A
    scheme left in the rewritten text raises `path:<scheme>`.
    """
    kept = df.columns
    df = df.withColumn("rewritten", F.col(text))
    raised = []
    for i, rule in enumerate(rules):
        step = {}
        present = F.contains("rewritten", F.lit(rule.token))
        if rule.flag:
            raised.append(f"_flag_{i}")
            hit = F.rlike("rewritten", F.lit(rule.when or rule.pattern))
            step[raised[-1]] = F.when(present & hit, F.lit(rule.flag))
        step["rewritten"] = F.when(
            present, F.regexp_replace("rewritten", rule.pattern, rule.replacement)
        ).otherwise(F.col("rewritten"))
        df = df.withColumns(step)
    flags = [F.col(f) for f in raised]
    for token, flag in (required or {}).items():
        flags.append(F.when(~F.contains("rewritten", F.lit(token)), F.lit(flag)))
    for scheme in schemes:
        flags.append(F.when(F.contains("rewritten", F.lit(scheme)), F.lit(f"path:{scheme}")))
    gathered = [
        F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1)).alias(name)
        for name, pattern in (collect or {}).items()
    ]
    return df.withColumn("flags", F.array_compact(F.array(*flags))).select(
        *kept, "rewritten", "flags", *gathered
    )


def secret_scan(df: DataFrame, text: str = "text", patterns=None, path: str = "path") -> DataFrame:
    """(path, kind, n_matches) for each kind of secret found in the whole text."""
    kinds = [
        F.struct(F.lit(kind).alias("kind"), F.regexp_count(F.col(text), F.lit(p)).alias("n_matches"))
        for kind, p in (patterns or SECRET_PATTERNS).items()
    ]
    return df.select(F.col(path), F.inline(F.array(*kinds))).filter("n_matches > 0")
