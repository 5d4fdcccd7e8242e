"""Lineage, project declarations and change impact, with pages as the source tree."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.functions.text import (
    extract_all,
    lookup,
    package_name,
    path_segment,
    source_label,
)
from tablewarden.operators import lineage
from tablewarden.plans.derived import frame, table, with_inputs
from tablewarden.sources.documents import manifest_edges, parse_manifests

LINK = '<a href="/([^"]+)"'


def nodes(spark, d):
    return frame(spark, d, "sites").select(
        F.concat(F.lit("page."), "page_id").alias("node_id"),
        F.col("label").alias("name"),
        F.col("url").alias("path"),
        F.regexp_extract_all("html", F.lit(LINK), F.lit(1)).alias("depends_on"),
    )


def edges(spark, d):
    return table(spark, d, "documents").select(
        F.concat(F.lit("page."), "doc_id").alias("node_id"),
        F.concat(F.lit("doc."), "source").alias("child_id"),
    )


def where_is(spark, d):
    return lineage.where_is(nodes(spark, d), edges(spark, d), "ththan")


def file_hits(spark, d):
    files = frame(spark, d, "sites").select(
        F.concat(F.lit("dbt/"), "lang", F.lit("/models/"), "kind", F.lit("/"), "label", F.lit(".sql")).alias("path")
    )
    return lineage.file_hits(files, "ththan")


def manifest_nodes(spark, d):
    found = parse_manifests(frame(spark, d, "manifests"))
    return found.select(
        "node_id", "name", "package_name", "path",
        F.coalesce("access", F.lit("-")).alias("access"), "materialized",
        F.coalesce("contract_enforced", F.lit(False)).alias("contract_enforced"),
        F.array_join("depends_on", ",").alias("depends_on"),
        F.array_join("consumed_by", ",").alias("consumed_by"),
    )


def manifest_readers(spark, d):
    found = manifest_edges(parse_manifests(frame(spark, d, "manifests")))
    return found.groupBy("child_id").agg(F.count(F.lit(1)).alias("n_models"))


def where_is_manifest(spark, d):
    """All that the manifests say about one model, its readers included."""
    return lineage.where_is_in_manifests(frame(spark, d, "manifests"), "src5")


def consumers_by_text(spark, d):
    catalogue = frame(spark, d, "sites").select(
        F.concat(
            F.lit("# catalogue\n| "), "label", F.lit(" | `apps/"), "label", F.lit("-"), "lang",
            F.lit("` | "), "host", F.lit(" |\n| other | `apps/other` | "), "kind", F.lit(" |"),
        ).alias("text")
    )
    return lineage.consumers_by_text(catalogue, "blog")


def expand_consumers(spark, d):
    libs = frame(spark, d, "changed_paths").filter("path LIKE 'libs/%'")
    changed = libs.select(path_segment(F.col("path"), 1).alias("lib"))
    return lineage.expand_consumers(changed, frame(spark, d, "declarations"))


def affected(spark, d):
    return lineage.affected(frame(spark, d, "changed_paths"), frame(spark, d, "declarations"))


def boundary_violations(spark, d):
    return lineage.boundary_violations(frame(spark, d, "imports"), frame(spark, d, "services"))


def projects(spark, d):
    """One declaration per event: inputs and outputs as arrays, possibly empty."""
    none = F.array().cast("array<string>")
    return frame(spark, d, "projects").select(
        "event_id", "name", "folder", "owner", "schedule",
        F.when(F.col("reads"), F.array("input", F.lit("raw.files"))).otherwise(none).alias("inputs"),
        F.when(F.col("writes"), F.array(F.concat(F.lit("gold."), "owner"))).otherwise(none).alias("outputs"),
    )


def project_catalogue(spark, d):
    return lineage.project_catalogue(projects(spark, d))


def external_sources(spark, d):
    return lineage.external_sources(projects(spark, d))


def read_matrix(spark, d):
    return lineage.read_matrix(projects(spark, d))


def read_edges(spark, d):
    return lineage.read_edges(projects(spark, d))


def keyword_search(spark, d):
    parts = table(spark, d, "part").withColumn("words", F.split("p_name", " "))
    return lineage.keyword_search(parts, "RING", ["p_type", "p_brand"], ["words"]).select(
        "p_partkey", "p_name"
    )


def path_parts(spark, d):
    """Label in parentheses, path segments, package name and matches, per page."""
    sites = frame(spark, d, "sites")
    return sites.select(
        "page_id",
        source_label(F.concat(F.lit("silver.x ("), "host", F.lit(") (y)"))).alias("source"),
        F.coalesce(path_segment(F.col("url"), 2), F.lit("")).alias("third"),
        package_name(F.concat("label", F.lit("-"), "lang")).alias("package"),
        F.array_join(extract_all(F.col("url"), "[a-z]+[.]example"), ",").alias("matches"),
    )


def map_lookup(spark, d):
    """A default for keys that a map lacks."""
    prices = F.create_map(F.lit("ECONOMY"), F.lit("low"), F.lit("PROMO"), F.lit("cut"))
    return table(spark, d, "part").select(
        "p_partkey", lookup(prices, F.col("p_type"), F.lit("list")).alias("price")
    )


def markdown_sections(spark, d):
    found = lineage.markdown_sections(frame(spark, d, "guides"))
    return found.select(
        "doc_id", "name", "owner", F.array_join("inputs", "; ").alias("inputs"),
        F.array_join("outputs", "; ").alias("outputs"), "schedule",
    )


def library_cards(spark, d):
    cards = lineage.library_cards(frame(spark, d, "guides"))
    found = lineage.keyword_search(cards, "SRC1", ["description"], ["provides"])
    return found.select(
        "doc_id", "owner", "description", F.array_join("provides", "; ").alias("provides")
    )


QUERIES = {
    "where_is": where_is,
    "file_hits": file_hits,
    "manifest_nodes": manifest_nodes,
    "manifest_readers": manifest_readers,
    "where_is_manifest": where_is_manifest,
    "consumers_by_text": consumers_by_text,
    "expand_consumers": expand_consumers,
    "affected": affected,
    "boundary_violations": boundary_violations,
    "project_catalogue": project_catalogue,
    "external_sources": external_sources,
    "read_matrix": read_matrix,
    "read_edges": read_edges,
    "keyword_search": keyword_search,
    "path_parts": path_parts,
    "map_lookup": map_lookup,
    "markdown_sections": markdown_sections,
    "library_cards": library_cards,
}

_S = with_inputs("sites")
_READS = """reads AS (
    SELECT DISTINCT name AS consumer, regexp_extract(input, '[(]([^)]+)[)]', 1) AS producer
    FROM projects WHERE reads AND regexp_extract(input, '[(]([^)]+)[)]', 1) <> '')"""
_SERVICES = ("svc-click", "svc-error", "svc-purchase", "svc-signup", "svc-view")
_LIBS = """libs AS (SELECT DISTINCT split_part(path, '/', 2) AS lib
    FROM changed_paths WHERE starts_with(path, 'libs/'))"""

SQL = {
    "where_is": f"""{_S}, hits AS (SELECT * FROM sites WHERE label = 'ththan')
        SELECT 'page.' || page_id AS node_id, 'located_at' AS relation, url AS other FROM hits
        UNION
        SELECT 'page.' || page_id, 'depends_on',
               unnest(regexp_extract_all(html, '<a href="/([^"]+)"', 1)) FROM hits
        UNION
        SELECT 'page.' || page_id, 'consumed_by', 'doc.' || source
        FROM hits JOIN documents ON doc_id = page_id""",
    "file_hits": f"""{_S}
        SELECT DISTINCT lang AS project, 'dbt/' || lang || '/models/' || kind || '/ththan.sql' AS path
        FROM sites WHERE label = 'ththan'""",
    "manifest_nodes": """
        SELECT 'model.' || doc_id AS node_id, source AS name, lang AS package_name,
               'models/' || doc_id || '.sql' AS path,
               CASE WHEN n_chars > 1000 THEN 'public' ELSE '-' END AS access,
               'table' AS materialized, lang = 'en' AS contract_enforced,
               'source.' || lang || ',source.' || source AS depends_on,
               CASE WHEN lang = 'de' THEN '' ELSE 'mart.' || source END AS consumed_by
        FROM documents WHERE lang <> 'es'""",
    "manifest_readers": """
        SELECT 'mart.' || source AS child_id, COUNT(*) AS n_models FROM documents
        WHERE lang NOT IN ('de', 'es') GROUP BY source""",
    "where_is_manifest": """WITH hits AS (
            SELECT *, 'model.' || doc_id AS node_id FROM documents WHERE source = 'src5' AND lang <> 'es')
        SELECT node_id, 'located_at' AS relation, 'models/' || doc_id || '.sql' AS other FROM hits
        UNION SELECT node_id, 'project', lang FROM hits
        UNION SELECT node_id, 'access', 'public' FROM hits WHERE n_chars > 1000
        UNION SELECT node_id, 'materialized', 'table' FROM hits
        UNION SELECT node_id, 'contract_enforced', 'true' FROM hits WHERE lang = 'en'
        UNION SELECT node_id, 'classification', CASE lang WHEN 'fr' THEN 'Restricted' ELSE 'Official-Open' END
              FROM hits
        UNION SELECT node_id, 'pii', CASE lang WHEN 'fr' THEN 'true' ELSE 'false' END FROM hits
        UNION SELECT node_id, 'depends_on', unnest(['source.' || lang, 'source.' || source]) FROM hits
        UNION SELECT node_id, 'consumed_by', 'mart.' || source FROM hits WHERE lang <> 'de'""",
    "consumers_by_text": f"""{_S}
        SELECT DISTINCT 'apps/' || label || '-' || lang AS consumer FROM sites
        WHERE contains(label || host, 'blog')
        UNION
        SELECT DISTINCT 'apps/other' FROM sites WHERE kind = 'blog'""",
    "expand_consumers": f"""{with_inputs("changed_paths", "declarations")}, {_LIBS}
        SELECT DISTINCT lib, app FROM libs JOIN declarations ON contains(text, lib)""",
    "affected": f"""{with_inputs("changed_paths", "declarations")}, {_LIBS}
        SELECT DISTINCT CASE split_part(path, '/', 1) WHEN 'apps' THEN 'app' WHEN 'libs' THEN 'lib'
                        WHEN 'dbt' THEN 'model_project' ELSE 'global' END AS kind,
               CASE WHEN starts_with(path, 'infra/') THEN '' ELSE split_part(path, '/', 2) END
                   AS name
        FROM changed_paths
        UNION
        SELECT 'app', app FROM libs JOIN declarations ON contains(text, lib)""",
    "boundary_violations": with_inputs("imports")
    + """ SELECT app, module, CASE split_part(module, '.', 1) WHEN 'svc_click' THEN 'svc-click'
               WHEN 'svc_view' THEN 'svc-view' ELSE 'svc-signup' END AS foreign_app
        FROM imports
        WHERE split_part(module, '.', 1) IN ('svc_click', 'svc_view', 'svc_signup')
          AND app <> replace(split_part(module, '.', 1), '_', '-')""",
    "project_catalogue": with_inputs("projects")
    + """ SELECT name, folder, owner,
               CASE WHEN reads THEN input || ', raw.files' ELSE '—' END AS reads_from,
               CASE WHEN writes THEN 'gold.' || owner ELSE '—' END AS writes_to,
               CASE WHEN schedule = '' THEN '—' ELSE schedule END AS schedule
        FROM projects""",
    "external_sources": f"""{with_inputs("projects")}, {_READS}
        SELECT DISTINCT producer AS source FROM reads
        WHERE producer NOT IN (SELECT name FROM projects)""",
    "read_matrix": f"""{with_inputs("projects")}, {_READS}
        SELECT p.name AS consumer, """
    + ", ".join(
        f"""COALESCE(bool_or(r.producer = '{s}'), FALSE) AS "{s}\""""
        for s in _SERVICES
    )
    + """ FROM (SELECT DISTINCT name FROM projects) p LEFT JOIN reads r ON r.consumer = p.name
        GROUP BY p.name""",
    "read_edges": f"""{with_inputs("projects")}, {_READS}
        SELECT consumer, producer FROM reads WHERE producer IN (SELECT name FROM projects)""",
    "keyword_search": """SELECT p_partkey, p_name FROM part
        WHERE p_type ILIKE '%ring%' OR p_brand ILIKE '%ring%' OR p_name ILIKE '%ring%'""",
    "path_parts": f"""{_S}
        SELECT page_id, host AS source, split_part(url, '/', 3) AS third,
               replace(label || '-' || lang, '-', '_') AS package,
               array_to_string(regexp_extract_all(url, '[a-z]+[.]example'), ',') AS matches
        FROM sites""",
    "map_lookup": """SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'low' WHEN 'PROMO' THEN 'cut'
               ELSE 'list' END AS price FROM part""",
    "markdown_sections": """
        SELECT doc_id, source AS name, '@' || lang || '-team' AS owner,
               'silver.' || lang || ' (' || source || '); raw.text' AS inputs,
               CASE WHEN lang = 'de' THEN '' ELSE 'gold.doc_' || doc_id END AS outputs,
               CASE WHEN lang = 'fr' THEN '' ELSE 'daily ' || n_chars END AS schedule
        FROM documents""",
    "library_cards": """
        SELECT doc_id, '@' || lang || '-team' AS owner, '' AS description,
               source || ' reader' AS provides
        FROM documents WHERE source LIKE 'src1%'""",
}
