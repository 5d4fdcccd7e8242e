"""Corpus checks over whole documents, pages and job definitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.context import shared_dir
from tablewarden.operators import contract, corpus
from tablewarden.plans.derived import frame, table, with_inputs
from tablewarden.sources.documents import read_corpus
from tablewarden.sources.export import export_with_header

LINT = corpus.LintRules(
    max_lines=10,
    required_any=("license", "the "),
    required_sections={"^/apps/": ("inputs", "outputs")},
)
SCHEMES = ("https://", "http://", "mailto:", "<script", 'lang="fr"')


def lint_documents(spark, d):
    return corpus.lint_documents(frame(spark, d, "mails"), LINT)


def lint_guides(spark, d):
    """Documents that do have a heading and sections."""
    guides = frame(spark, d, "guides").withColumn("path", F.concat(F.lit("/apps/"), "doc_id"))
    return corpus.lint_documents(guides, LINT)


def forbidden_lines(spark, d):
    found = corpus.forbidden_lines(
        table(spark, d, "documents"), ("the", "License", "token"), ("MIT", " of "), "doc_id"
    )
    return found.withColumn("line_no", F.col("line_no").cast("bigint"))


def hardcoded_paths(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.concat_ws(" ", "url", "html").alias("text"))
    return corpus.hardcoded_paths(pages, "text", SCHEMES, "page_id")


def rewrite_refs(spark, d):
    found = corpus.rewrite_refs(
        frame(spark, d, "jobs"),
        corpus.job_rewrites(("lake_dev", "lake_staging", "lake_prod")),
        required={"run_as:": "no_run_as"},
        collect={"notebooks": corpus.NOTEBOOK_PATH},
    )
    return found.select(
        "path", "rewritten", F.array_join("flags", ",").alias("flags"),
        F.array_join("notebooks", ",").alias("notebooks"),
    )


def corpus_files(spark, d):
    """Whole texts written as files, a folder a source, and read back. The sources of one
    language are packed, and left out by what their names end in."""
    root = shared_dir(spark) + "/corpus"
    docs = table(spark, d, "documents").filter("text IS NOT NULL")
    for packed in (False, True):
        part = docs.filter((F.col("lang") == "es") == F.lit(packed)).select(
            "source", F.col("text").alias("value"))
        part.write.mode("append").option("compression", "gzip" if packed else "none").partitionBy(
            "source").text(root)
    files = read_corpus(spark, [f"{root}/source=*/*"], exclude=[".txt.gz"])
    each = files.select(
        F.regexp_extract("path", "source=([^/]+)/", 1).alias("source"),
        F.explode(F.split(F.regexp_replace("text", "\n$", ""), "\n")).alias("line"),
    )
    return each.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.length("line")).alias("n_chars"),
        F.sum(F.conv(F.substring(F.md5("line"), 1, 8), 16, 10).cast("bigint")).alias("digest"),
    )


def export_header(spark, d):
    """A tagged export written as CSV; header lines are counted apart from rows."""
    parts = table(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    tagged = contract.apply_tags(parts, {"p_name": {"classification": "Restricted"}})
    path = export_with_header(tagged.repartition(3), shared_dir(spark) + "/export")
    value = F.col("value")
    kind = (
        F.when(F.startswith(value, F.lit("# classification: Restricted")), F.lit("header"))
        .when(value == "p_partkey,p_name,p_brand", F.lit("columns"))
        .otherwise("row")
    )
    return spark.read.text(path).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "lint_documents": lint_documents,
    "lint_guides": lint_guides,
    "forbidden_lines": forbidden_lines,
    "hardcoded_paths": hardcoded_paths,
    "rewrite_refs": rewrite_refs,
    "corpus_files": corpus_files,
    "export_header": export_header,
}

_LINES = "string_split(regexp_replace(text, '\\n$', ''), chr(10))"
_PHRASES = "(VALUES ('the'), ('License'), ('token')) p(phrase)"

SQL = {
    "lint_documents": f"""{with_inputs("mails")}, sized AS (
        SELECT path, text, CASE WHEN text = '' THEN 0 ELSE len({_LINES}) END AS n FROM mails)
        SELECT path, 'no_heading' AS rule FROM sized WHERE NOT starts_with(text, '# ')
        UNION ALL SELECT path, 'too_long' FROM sized WHERE n > 10
        UNION ALL SELECT path, 'no_required_phrase' FROM sized
            WHERE NOT contains(lower(text), 'license') AND NOT contains(lower(text), 'the ')
        UNION ALL SELECT path, 'no_section:' || s FROM sized, (VALUES ('inputs'), ('outputs')) v(s)
            WHERE starts_with(path, '/apps/')
              AND NOT regexp_matches(text, '(?im)^## *' || s || ' *$')""",
    "lint_guides": f"""{with_inputs("guides")}, sized AS (
        SELECT '/apps/' || doc_id AS path, text, len({_LINES}) AS n FROM guides)
        SELECT path, 'too_long' AS rule FROM sized WHERE n > 10
        UNION ALL SELECT path, 'no_required_phrase' FROM sized
            WHERE NOT contains(lower(text), 'license') AND NOT contains(lower(text), 'the ')""",
    "forbidden_lines": f"""WITH numbered AS (
            SELECT doc_id, unnest({_LINES}) AS line,
                   unnest(range(1, len({_LINES}) + 1)) AS line_no
            FROM documents)
        SELECT doc_id, line_no, phrase FROM numbered JOIN {_PHRASES} ON contains(line, phrase)
        WHERE NOT contains(line, 'MIT') AND NOT contains(line, ' of ')""",
    "hardcoded_paths": """SELECT page_id, scheme FROM pages
        JOIN (VALUES ('https://'), ('http://'), ('mailto:'), ('<script'), ('lang="fr"')) s(scheme)
          ON contains(url || ' ' || html, scheme)""",
    "rewrite_refs": """
        SELECT o_orderkey AS path,
               'resources:' || chr(10) ||
               '  catalog: ' || CASE WHEN o_orderstatus IN ('F', 'O') THEN '${var.catalog}'
                                     ELSE 'other' END || chr(10) ||
               '  notebook_path: ./notebooks/load_' || o_orderkey ||
               CASE WHEN o_totalprice > 200000 THEN '.sql' ELSE '.py' END || chr(10) ||
               '  node_type_id: ${var.cluster_node_type_id}' || chr(10) ||
               '  num_workers: ${var.cluster_num_workers}' || chr(10) ||
               CASE WHEN o_orderpriority = '1-URGENT' THEN '  run_as: me' || chr(10) ELSE '' END ||
               CASE WHEN o_orderpriority = '5-LOW' THEN '  data: s3://old/' || o_orderkey
                    ELSE '' END AS rewritten,
               CASE WHEN o_orderstatus IN ('F', 'O') THEN 'catalog,' ELSE '' END ||
               'notebook_path,node_type_id,num_workers' ||
               CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE ',no_run_as' END ||
               CASE WHEN o_orderpriority = '5-LOW' THEN ',path:s3://' ELSE '' END AS flags,
               '/Workspace/Users/u' || o_custkey || '/load_' || o_orderkey ||
               CASE WHEN o_totalprice > 200000 THEN '.sql' ELSE '' END AS notebooks
        FROM orders""",
    "corpus_files": """WITH each AS (
            SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents
            WHERE lang IS DISTINCT FROM 'es' AND text IS NOT NULL)
        SELECT source, COUNT(*) AS n_lines, CAST(SUM(length(line)) AS BIGINT) AS n_chars,
               CAST(SUM(CAST('0x' || substr(md5(line), 1, 8) AS BIGINT)) AS BIGINT) AS digest
        FROM each GROUP BY source""",
    "export_header": """SELECT 'row' AS kind, COUNT(*) AS n FROM part
        UNION ALL SELECT 'header', 3 UNION ALL SELECT 'columns', 3""",
}
